import zlib

from flowframe.llm import language
from flowframe.llm.language import Classifier, identify, learn, learnable, letters
from flowframe.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, score string"


def test_letters():
    assert letters("Ab--12 cD\n\n_É!") == "ab cd é".encode()
    assert letters("12 _ %%") == letters("") == b""


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op9_zstd_language"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held)
    assert right > 0.97, right
    sure = [r for r in held if not r.rejected]
    assert len(sure) > 0.97 * len(held) and sum(r.lang_pred == docs[r.doc_id].lang for r in sure) / len(sure) > 0.98


def test_brute_force_sizes():
    """Sizes are those of the library over blocks of the whole text; the smallest wins, ties by name."""
    import zstandard

    model = {"aa": b"lorem ipsum dolor sit amet " * 50, "bb": b"quick brown fox jumps over " * 50}
    ours = Classifier(model)
    text = "the quick brown fox jumps over " * 300
    data = letters(text)
    want = {}
    for name, raw in model.items():
        made = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        options = zstandard.ZstdCompressionParameters.from_level(6, write_content_size=0, write_checksum=0, write_dict_id=0)
        one = zstandard.ZstdCompressor(dict_data=made, compression_params=options)
        want[name] = sum(len(one.compress(data[i : i + 2048])) for i in range(0, len(data), 2048))
    assert ours.sizes(data).keys() == want.keys()
    assert min(ours.sizes(data), key=ours.sizes(data).get) == min(want, key=want.get) == "bb"
    assert ours.predict(text, 0.0)[0] == "bb" and not ours.predict(text, 0.0)[2]
    same = Classifier({"xx": model["aa"], "ww": model["aa"]})
    assert same.predict(text, 0.005)[0] == "ww" and same.predict(text, 0.005)[2]


def test_rows_of_every_kind(spark):
    texts = ["el gato come pescado en la casa", "the cat eats fish in the house", None, "", "12 34 !!", "x", "the house " * 200_000]
    rows = [(i, t, ["es", "en", None, "en", "es", None, "en"][i], "clash") for i, t in enumerate(texts)] + [(1, texts[1], "en", "")] * 3
    df = spark.createDataFrame(rows, SCHEMA)
    out = identify(df, learn(df))
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score", "rejected"]
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(rows)
    assert got[0].lang_pred == "es" and got[1].lang_pred == "en" and got[6].lang_pred == "en"
    assert all((got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True) for i in (2, 3, 4))


def test_nothing_to_learn_and_empty_table(spark):
    df = spark.createDataFrame([(1, "text", None, "")], SCHEMA)
    assert learn(df) == {} and identify(df, {}).first().lang_pred == "und"
    assert identify(df.filter("false"), {"en": b"x"}).collect() == []


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(language, "BYTES", 100)
    df = spark.range(1000).selectExpr("id as doc_id", "concat('word', id) as text", "if(id % 2 = 0, 'a', 'b') as lang")
    model = learn(df)
    assert set(model) == {"a", "b"} and all(len(x) <= 100 for x in model.values())
    learnt = df.filter(learnable())
    assert learnt.count() == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(1000))


def test_marks_stay_with_their_letters_and_null_ids_are_not_held_out(spark, tmp_path):
    from flowframe.llm.queries import QUERIES

    assert language.letters("हिन्दी भाषा, 2²_x!").decode() == "हिन्दी भाषा x"
    assert language.letters("\u0301 12") == b""
    df = spark.createDataFrame([(None, "der die das", "de", ""), (1, "el la los", "es", "")], SCHEMA)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r.held_out for r in QUERIES["op9_zstd_language"](spark, str(tmp_path)).collect()}
    assert out[None] is False and out[1] is (zlib.crc32(b"1") % 4 == 2)
