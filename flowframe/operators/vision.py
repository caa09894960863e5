"""Image inference with the user's predictor, and the shapes of its results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowframe.functions.columns import as_col

# The score a detection must exceed, and the candidates looked at per image.
SCORE_THRESHOLD = 0.3
CANDIDATES = 10

# The header the predictions go to, and the JSON shape per task.
PREDICTION_HEADER = "cvjson"
PREDICTION_SCHEMAS = {
    "classification": "array<struct<className:string,probability:double>>",
    "detection": (
        "array<struct<className:string,probability:double,"
        "boundingBox:struct<x:double,y:double,width:double,height:double>>>"
    ),
    "joints": "array<struct<x:double,y:double,confidence:double>>",
    "mask": "struct<classes:array<string>,mask:array<array<int>>>",
}


def prediction_to_json(value: str | Column) -> Column:
    return F.to_json(as_col(value))


def prediction_from_json(text: str | Column, task: str) -> Column:
    return F.from_json(as_col(text), PREDICTION_SCHEMAS[task])


def detection_postprocess(
    df: DataFrame,
    labels: DataFrame | None = None,
    *,
    image: str = "image",
    rank: str | Column = "rank",
    class_id: str | Column = "class_id",
    score: str | Column = "score",
    box: tuple[str, str, str, str] = ("y_min", "x_min", "y_max", "x_max"),
    threshold: float = SCORE_THRESHOLD,
    candidates: int = CANDIDATES,
) -> DataFrame:
    """Detections worth keeping, labelled, with corner boxes turned into x, y, w, h.

    Only the first ``candidates`` per image count, taken before the score is
    looked at; ``rank`` gives their 1-based place, as the predictor returns them
    in order. Class 0 is the background. ``labels`` (class_id, label) names the
    classes; a class without a name is called ``#id``. Spark broadcasts the
    labels if they are small and joins by shuffle if they are not.
    """
    y_min, x_min, y_max, x_max = (as_col(side) for side in box)
    kept = df.filter(
        (as_col(rank) <= candidates) & (as_col(class_id) > 0) & (as_col(score) > threshold)
    ).select(
        F.col(image),
        as_col(rank).alias("rank"),
        as_col(class_id).alias("class_id"),
        as_col(score).alias("probability"),
        x_min.alias("x"),
        y_min.alias("y"),
        (x_max - x_min).alias("width"),
        (y_max - y_min).alias("height"),
    )
    fallback = F.concat(F.lit("#"), F.col("class_id").cast("string"))
    if labels is None:
        return kept.withColumn("class_name", fallback)
    named = kept.join(labels.select("class_id", F.col("label").alias("__label")), "class_id", "left")
    return named.withColumn("class_name", F.coalesce("__label", fallback)).drop("__label")


def image_inference(
    df: DataFrame,
    load_predictor: Callable[[], Callable[[bytes], tuple[str, bytes | None]]],
    *,
    header: str = PREDICTION_HEADER,
    augment: bool = False,
) -> DataFrame:
    """Run a predictor over binary payloads; its JSON goes to a header.

    ``load_predictor`` runs once per task and returns a function of the image
    bytes giving (JSON text, annotated PNG or None). The payload is the input
    image, or with ``augment`` the annotated one.
    """
    out = T.StructType(df.schema.fields + [T.StructField("__json", T.StringType())])

    def predict(batches):
        import pyarrow as pa

        run = load_predictor()
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            images = columns["payload"].to_pylist()
            results = [run(image) for image in images]
            if augment:
                drawn = [image if png is None else png for image, (_, png) in zip(images, results)]
                columns["payload"] = pa.array(drawn, pa.binary())
            columns["__json"] = pa.array([text for text, _ in results], pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    seen = df.mapInArrow(predict, out)
    others = F.map_filter("headers", lambda name, _: name != header)
    added = F.create_map(F.lit(header), F.col("__json"))
    return seen.withColumn("headers", F.map_concat(others, added)).drop("__json")
