"""Files as rows: whole, by line, with markers, as references; and what happens after."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowframe.functions.columns import as_col, text_of, text_or_null
from flowframe.functions.patterns import ant_to_regex, full_match
from flowframe.operators.split import marker_json
from flowframe.plans.scratch import qualified, task_store
from flowframe.plans.spans import kept
from flowframe.sources.listing import listed_facts, listed_files, read_listed


#: What a file counts beside its bytes where small files are packed into tasks. Spark's own 4 MB makes a task of each 32 of them.
OPEN_COST = 262_144


def _packing(spark: SparkSession) -> SparkSession:
    """A session with the settings of this one, whose readers pack very many small files into few tasks.

    The cost of opening a file is a setting of the session that a reader belongs to, and is looked
    up when rows are read, so it can not be set for a time.
    """
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set("spark.sql.files.openCostInBytes", min(OPEN_COST, spark._jsparkSession.sessionState().conf().filesOpenCostInBytes()))
    return own


def _taken(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows of the packing session as a frame of ``spark``; Spark drops the empty side of the union."""
    none = [F.lit(None).cast(field.dataType).alias(field.name) for field in rows.schema]
    return spark.range(1).filter("false").select(*none).unionByName(rows)


CONTENTS = "path string, modified timestamp, size bigint, payload binary"


def _contents(batches):
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        data = batch.column("content")
        columns = [batch.column("path"), batch.column("modified"), pc.binary_length(data).cast(pa.int64()), data]
        yield pa.RecordBatch.from_arrays(columns, names=["path", "modified", "size", "payload"])


def file_contents_scan(spark: SparkSession, path: str | list[str], *, glob: str | None = None) -> DataFrame:
    """One row per file: path, size, content type and all bytes as the payload.

    Files are listed in tasks where these have a store for the path, and small ones read there; large ones come by Spark's reader.
    """
    reader = _packing(spark).read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    columns = ["path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"), F.col("content").alias("payload")]
    listed = listed_files(spark, path, glob)
    if listed is None:
        files = _taken(spark, reader.load(path)).select(*columns)
    else:
        small = F.col("size") <= OPEN_COST
        facts = listed_facts(listed, small)
        files = read_listed(listed.filter(small), facts, _contents, CONTENTS)
        if facts["others"]:
            files = files.unionByName(_taken(spark, reader.load(path).filter(F.col("length") > OPEN_COST)).select(*columns))
    return files.select("*", F.create_map(F.lit("contentType"), F.lit("application/octet-stream")).alias("headers"))


#: Endings of files that only the line reader unpacks; some more do no harm.
PACKED = r"[.](deflate|bz2|gz|lz4|snappy|zst|lzo|xz)$"


Whole = Callable[[Callable[[Iterator], Iterator]], DataFrame]


def _lines(spark: SparkSession, path: str | list[str], glob: str | None, charset: str) -> tuple[DataFrame | None, Whole | None, Callable[[Column], Column]]:
    """The line reader's lines with the place of their split, what cuts small files that come whole, and what makes text of a line's bytes.

    By the line reader a small file takes several times as long as by a reader of whole
    files. So files that are never split come whole, to be cut where they are read; if there
    are no others, there are no lines of the reader, and files are listed once: in tasks, if
    these have a store for the path.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    own = _packing(spark).read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob is not None:
        reader, own = reader.option("pathGlobFilter", glob), own.option("pathGlobFilter", glob)
    size, place = F.col("_metadata.file_size"), F.col("_metadata.file_path")
    whole, large = None, None
    if not charset.upper().startswith(("UTF-16", "UTF-32")):
        most = min(OPEN_COST, spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
        large = (size > most) | place.rlike(PACKED)
        listed = listed_files(spark, path, glob)
        if listed is not None:
            small = (F.col("size") <= most) & ~F.col("path").rlike(PACKED)
            facts = listed_facts(listed, small)
            whole = lambda cut: read_listed(listed.filter(small), facts, cut, LINES)
            split = facts["others"] > 0
        else:
            found = own.load(path)
            contents = _taken(spark, found.filter(~large).select(place.alias("url"), "content"))
            whole = lambda cut: contents.mapInArrow(cut, LINES)
            split = bool(found.filter(large).select("path").head(1))
        if not split:
            return None, whole, _text(charset)
    else:
        reader = reader.option("encoding", charset).option("lineSep", "\n")
    lines = reader.text(path)
    lines = (lines if large is None else lines.filter(large)).select(
        "value",
        place.alias("path"),
        F.col("_metadata.file_block_start").alias("split_start"),
        size.alias("__file_size"),
        (F.col("_metadata.file_block_length") == size).alias("__whole"),
    )
    return lines, whole, _text(charset)


def _text(charset: str) -> Callable[[Column], Column]:
    def text(value: Column) -> Column:
        if charset.upper() in ("UTF-8", "US-ASCII"):
            return value
        # The reader cuts lines by bytes and leaves their encoding alone.
        value = text_of(value.cast("binary"), charset)
        return F.regexp_replace(value, r"\r\z", "") if charset.upper().startswith(("UTF-16", "UTF-32")) else value

    return text


LINES = "path string, split_start bigint, payload string, line_no bigint, mark string"
#: Bytes of lines that leave a task at a time, and what a line costs beside its bytes.
GATHERED, LINE_COST = 4_000_000, 100


def _lines_of_whole(marks: bool):
    """The numbered lines of files that come whole, cut as the line reader cuts them; ``marks`` as in ``_line_numbers``."""

    def cut(batches):
        import pyarrow as pa

        def as_batch(paths, payloads, numbers, kinds):
            # Bytes stay as they are, whether they are good text or not.
            columns = [pa.array(paths, pa.string()), pa.repeat(pa.scalar(0, pa.int64()), len(paths)), pa.array(payloads, pa.binary()).view(pa.string()), pa.array(numbers, pa.int64()), pa.array(kinds, pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["path", "split_start", "payload", "line_no", "mark"])

        for batch in batches:
            held, size = ([], [], [], []), 0
            for path, content in zip(batch.column("url"), batch.column("content"), strict=True):
                data = content.as_py()
                lines = data.removeprefix(b"\xef\xbb\xbf").splitlines()
                if not lines:
                    continue
                n = len(lines)
                rows = ([None, *lines, None], range(n + 2), ["START", *[None] * n, "END"]) if marks else (lines, range(1, n + 1), [None] * n)
                for column, values in zip(held, ([path.as_py()] * len(rows[0]), *rows), strict=True):
                    column.extend(values)
                size += len(data) + LINE_COST * n
                if size >= GATHERED:
                    yield as_batch(*held)
                    held, size = ([], [], [], []), 0
            if held[0]:
                yield as_batch(*held)

    return cut


def _line_headers() -> Column:
    return F.create_map(F.lit("contentType"), F.lit("text/plain")).alias("headers")


def file_lines_scan(
    spark: SparkSession,
    path: str | list[str],
    *,
    glob: str | None = None,
    charset: str = "UTF-8",
    numbered: bool = False,
) -> DataFrame:
    """One row per line. Large files are read in splits by many tasks.

    Within a file ``(split_start, line_id)`` gives the order; ``numbered`` adds the
    1-based ``line_no`` (see ``_counted``). Neither shuffles the lines.
    """
    lines, whole, text = _lines(spark, path, glob, charset)
    columns = ["path", "split_start", F.monotonically_increasing_id().alias("line_id"), "payload", _line_headers()]
    if numbered:
        return _counted(lines, whole, text, marks=False).select(*columns, "line_no")
    rows = None if lines is None else lines.select("path", "split_start", text(F.col("value")).alias("payload"))
    if whole is not None:
        cut = whole(_lines_of_whole(False)).select("path", "split_start", text(F.col("payload")).alias("payload"))
        rows = cut if rows is None else rows.unionByName(cut)
    return rows.select(*columns)


def file_lines_with_markers(spark: SparkSession, path: str | list[str], *, glob: str | None = None, charset: str = "UTF-8") -> DataFrame:
    """The lines of each file with a START row (``seq`` 0) and an END row with the line count behind the last line.

    Rows are in order by (path, seq). The marks come out of the same reading as the lines.
    """
    rows = _counted(*_lines(spark, path, glob, charset), marks=True)
    mark = F.when(F.col("mark") == "START", marker_json("path", "START", F.lit(0))).when(
        F.col("mark") == "END", marker_json("path", "END", F.col("line_no") - 1)
    )
    return rows.select("path", F.col("line_no").alias("seq"), F.coalesce(mark, "payload").alias("payload"))


#: Splits up to which the lines before each are broadcast.
FEW_SPLITS = 100_000


def _counted(lines: DataFrame | None, whole: Whole | None, text: Callable[[Column], Column], *, marks: bool) -> DataFrame:
    """The lines with ``line_no``, and rows with a ``mark`` if wanted; no line is shuffled.

    A task counts the lines of each split as it reads them. Only files read in several
    splits need the lines before a split: their splits are counted first, and the sums
    are one small row per split. Files too small to be split are left out of that count
    when files are listed.
    """
    if whole is not None:
        numbered = whole(_lines_of_whole(marks)).withColumn("payload", text(F.col("payload")))
        return numbered if lines is None else numbered.unionByName(_counted(lines, None, text, marks=marks))
    spark = lines.sparkSession
    settings = spark._jsparkSession.sessionState().conf()
    never_cut = min(settings.filesMaxPartitionBytes(), settings.filesOpenCostInBytes())
    at = ["path", "split_start"]
    cut = lines.filter((F.col("__file_size") > never_cut) & ~F.col("__whole"))
    before = Window.partitionBy("path").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy(*at).agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    counts = kept(counts, "splits")
    number = counts.count()
    read = lines.select(*at, "__whole", text(F.col("value")).alias("payload"))
    rows = read.mapInArrow(_line_numbers(marks), LINES)
    if number:
        offsets = counts.select(*[F.col(name).alias(f"__{name}") for name in at], "before")
        offsets = F.broadcast(offsets) if number <= FEW_SPLITS else offsets
        same = (F.col("path") == F.col("__path")) & (F.col("split_start") == F.col("__split_start"))
        moved = F.when(F.col("mark").isNull(), F.col("line_no") + F.coalesce("before", F.lit(0))).otherwise(F.col("line_no"))
        rows = rows.join(offsets, same, "left").withColumn("line_no", moved).drop("__path", "__split_start", "before")
        if marks:
            ends = counts.groupBy("path").agg(F.min("split_start").alias("split_start"), F.sum("n").alias("n"))
            none = F.lit(None).cast("string")
            rows = rows.unionByName(ends.select("path", "split_start", none.alias("payload"), (F.col("n") + 1).alias("line_no"), F.lit("END").alias("mark")))
    return rows


def _line_numbers(marks: bool):
    """Number the lines of each split; a split's lines follow each other."""

    def count(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        names = ["path", "split_start", "payload", "line_no", "mark"]

        def marked(rows):
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            path, start, line_no, mark = ([*column] for column in columns)
            return pa.RecordBatch.from_arrays(
                [pa.array(path, pa.string()), pa.array(start, pa.int64()), pa.nulls(len(path), pa.string()), pa.array(line_no, pa.int64()), pa.array(mark, pa.string())],
                names=names,
            )

        last, seen, whole = None, 0, False
        for batch in batches:
            if not batch.num_rows:
                continue
            paths, starts = batch.column("path"), batch.column("split_start").to_numpy()
            rows = batch.num_rows
            new = np.flatnonzero(pc.not_equal(paths.slice(1), paths.slice(0, rows - 1)).to_numpy(zero_copy_only=False) | (starts[1:] != starts[:-1])) + 1
            numbers, found = np.arange(1, rows + 1), []
            bounds = [0, *new.tolist(), rows]
            for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                split = (paths[low].as_py(), int(starts[low]))
                if split != last:
                    if last is not None and whole:
                        found.append((*last, seen + 1, "END"))
                    last, seen, whole = split, 0, batch.column("__whole")[low].as_py()
                    if split[1] == 0:
                        found.append((*split, 0, "START"))
                numbers[low:high] += seen - low
                seen += high - low
            yield pa.RecordBatch.from_arrays(
                [paths, batch.column("split_start"), batch.column("payload"), pa.array(numbers), pa.nulls(rows, pa.string())], names=names
            )
            if marks and found:
                yield marked(found)
        if marks and whole:
            yield marked([(*last, seen + 1, "END")])

    return count


def with_markers(
    lines: DataFrame, *, path: str = "path", line_no: str = "line_no", payload: str = "payload"
) -> DataFrame:
    """Add a START row (number 0) and an END row with the line count per file.

    Rows are in order by (path, line number); the END row comes after the last line.
    """
    body = lines.select(
        F.col(path).alias("path"), F.col(line_no).cast("bigint").alias("seq"), F.col(payload).alias("payload")
    )
    # The counts need the numbers only, so the second read of the lines carries no text.
    counts = lines.groupBy(F.col(path).alias("path")).agg(F.max(line_no).cast("bigint").alias("n"))
    marks = counts.select(
        "path",
        F.inline(
            F.array(
                F.struct(F.lit(0).cast("bigint").alias("seq"), marker_json("path", "START", F.lit(0)).alias("payload")),
                F.struct((F.col("n") + 1).alias("seq"), marker_json("path", "END", F.col("n")).alias("payload")),
            )
        ),
    )
    return body.unionByName(marks)


def file_ref_listing(
    spark: SparkSession,
    path: str | list[str],
    *,
    glob: str | None = None,
    sort_by: str | None = None,
    descending: bool = False,
) -> DataFrame:
    """Path, name, size and modified time of each file; contents are not read.

    ``sort_by`` is FILENAME or MTIME. Spark does not report access times.
    """
    found = listed_files(spark, path, glob)
    if found is None:
        reader = _packing(spark).read.format("binaryFile").option("recursiveFileLookup", "true")
        if glob is not None:
            reader = reader.option("pathGlobFilter", glob)
        found = _taken(spark, reader.load(path)).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    files = found.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "size", "modified")
    if sort_by is None:
        return files
    column = {"FILENAME": "name", "MTIME": "modified"}[sort_by.upper()]
    return files.orderBy(F.col(column).desc() if descending else F.col(column).asc(), "path")


def file_name_filter(
    df: DataFrame, name: str | Column = "name", *, pattern: str | None = None, regex: str | None = None
) -> DataFrame:
    """Keep names that match an ant pattern or, without one, a regular expression."""
    if pattern is None and regex is None:
        return df
    test = ant_to_regex(pattern) if pattern is not None else full_match(regex)
    return df.filter(as_col(name).rlike(test))


def accept_once(
    listing: DataFrame, ledger: DataFrame, *, key: list[str], modified: str = "modified"
) -> DataFrame:
    """Files never seen, or whose modified time differs from the one in the ledger."""
    names = [*key, modified]
    seen = ledger.select(*[F.col(name).alias(f"__{name}") for name in names])
    same = F.lit(True)
    for name in names:
        same = same & F.col(name).eqNullSafe(F.col(f"__{name}"))
    return listing.dropDuplicates(names).join(seen, same, "left_anti")


def merge_ledger(
    ledger: DataFrame, accepted: DataFrame, *, key: list[str], modified: str = "modified"
) -> DataFrame:
    """The ledger after a run: for each file the modified time it was last accepted with."""
    names = [*key, modified]
    both = ledger.select(*names, F.lit(0).alias("__run")).unionByName(
        accepted.select(*names, F.lit(1).alias("__run"))
    )
    return both.groupBy(*key).agg(F.max_by(modified, F.struct("__run", modified)).alias(modified))


def plan_disposition(
    read: DataFrame, *, path: str = "path", delete: bool = False, rename: str | Column | None = None
) -> DataFrame:
    """What to do with each read file: ``action`` (delete, rename, leave) and ``target``."""
    if delete and rename is not None:
        raise ValueError("deleting and renaming exclude each other")
    new_name = F.lit(None).cast("string") if rename is None else text_or_null(as_col(rename).cast("string"))
    action = F.lit("delete") if delete else F.when(F.col("target").isNotNull(), "rename").otherwise("leave")
    return (
        read.select(F.col(path).alias("path"), new_name.alias("target"))
        .distinct()
        .select("path", action.alias("action"), "target")
    )


def apply_disposition(plan: DataFrame) -> DataFrame:
    """Delete or move the files of a plan, in tasks; gives ``path`` and ``outcome``.

    A path without a scheme is one of Spark's default file system. Safe to repeat: a
    file that is already gone counts as done. An action on the result runs it, so
    write the outcome to a table.
    """
    root = qualified(plan.sparkSession, "/").rstrip("/")

    def act(batches):
        import posixpath

        import pyarrow as pa
        from pyarrow import fs

        def opened(uri):
            return task_store(uri if ":" in uri.split("/", 1)[0] else root + uri)

        for batch in batches:
            outcomes = []
            for source, action, target in zip(*(batch.column(k).to_pylist() for k in ("path", "action", "target")), strict=True):
                store, place = opened(source)
                if action == "leave":
                    outcomes.append("left")
                elif store.get_file_info(place).type == fs.FileType.NotFound:
                    outcomes.append("gone")
                elif action == "delete":
                    store.delete_file(place)
                    outcomes.append("deleted")
                else:
                    to = opened(target)[1] if "/" in target else posixpath.join(posixpath.dirname(place), target)
                    store.create_dir(posixpath.dirname(to), recursive=True)
                    store.move(place, to)
                    outcomes.append("renamed")
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(outcomes, pa.string())], names=["path", "outcome"])

    return plan.select("path", "action", "target").mapInArrow(act, "path string, outcome string")


# Fixed value: the header that names the server a file came from.
SERVER_HEADER = "sftp_selectedServer"


def multi_source_read(
    spark: SparkSession, sources: list[str], directories: dict[str, str], *, header: str = SERVER_HEADER
) -> DataFrame:
    """Lines of several ``server.directory`` sources; the server's name goes to a header.

    ``directories`` maps a server to the root its directories lie under. Equal
    servers share one scan.
    """
    by_server: dict[str, list[str]] = {}
    for source in sources:
        if source.count(".") != 1:
            raise ValueError(f"'{source}' is not of the form server.directory")
        server, directory = source.split(".")
        by_server.setdefault(server, []).append(f"{directories[server].rstrip('/')}/{directory}")
    frames = [
        file_lines_scan(spark, paths).withColumn(
            "headers", F.map_concat("headers", F.create_map(F.lit(header), F.lit(server)))
        )
        for server, paths in by_server.items()
    ]
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame)
    return merged


def capped_poll(
    listing: DataFrame, sources: list[str], cap: int, order_by: list[str], *, source: str = "source", fair: bool = True, start: int = 0
) -> tuple[DataFrame, int]:
    """At most ``cap`` of the listed rows over all ``sources``, and where the next poll starts.

    Fair reading takes one row of each source in turn, beginning with number ``start`` of
    the list; a source that has no more is passed over. Otherwise each source is read to its
    end before the next. Within a source rows come in ``order_by``, which must be total.
    The shares follow from one count per source, so that no rows are sorted across sources,
    and each task keeps at most ``cap`` rows of a source before the shuffle.
    """
    if cap < 1:
        raise ValueError("a poll takes at least one row")
    listed = listing.filter(F.col(source).isin(*sources))
    known = {row[source]: row["n"] for row in listed.groupBy(source).agg(F.count(F.lit(1)).alias("n")).collect()}
    turn = [sources[(start + k) % len(sources)] for k in range(len(sources))]
    left = {name: known.get(name, 0) for name in turn}
    share = dict.fromkeys(turn, 0)
    following = start % len(sources)
    while cap and any(left.values()):
        open_ = [name for name in turn if left[name]]
        each = min(left[name] for name in open_) if fair else 0
        if fair and each * len(open_) <= cap:
            # Whole rounds, up to the end of the smallest source.
            taken = dict.fromkeys(open_, each)
        elif fair:
            rounds, rest = divmod(cap, len(open_))
            taken = {name: rounds + (k < rest) for k, name in enumerate(open_)}
        else:
            taken = {open_[0]: min(left[open_[0]], cap)}
        for name, n in taken.items():
            share[name] += n
            left[name] -= n
            cap -= n
        last = [name for name in open_ if taken.get(name)][-1] if not fair or cap else [*open_][((sum(taken.values()) - 1) % len(open_))]
        following = sources.index(last) if not fair and left[last] else (sources.index(last) + 1) % len(sources)
    most = max(share.values(), default=0)
    rank = F.row_number().over(Window.partitionBy(source).orderBy(*order_by))
    own = F.lit(0)
    for name, n in share.items():
        own = F.when(F.col(source) == name, n).otherwise(own)
    # The constant bound lets each task cut its rows of a source before they move.
    ranked = listed.withColumn("__rank", rank).filter(F.col("__rank") <= most)
    return ranked.filter(F.col("__rank") <= own).drop("__rank"), following
