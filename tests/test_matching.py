import random
import re

import numpy as np
import pytest

from flowframe.sources.feeds import stream_filter, stream_filter_many
from flowframe.sources.matching import Boxes, Phrases


def holds(text, phrase):
    return all(re.search(rf"(?<![^\W]){re.escape(word)}(?![^\W])", text) for word in phrase.lower().split())


@pytest.mark.parametrize("seed", range(8))
def test_phrases_against_brute_force(seed):
    rng = random.Random(seed)
    words = ["a", "ab", "abc", "bc", "c", "é", "éa", "a_b", "a-b", "a.b", "日", "9", "ab9", "#tag", "@you"]
    phrases = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 3))) for _ in range(12)]
    found = Phrases(phrases)
    for _ in range(300):
        text = "".join(rng.choice([*words, " ", " ", "-", "!"]) for _ in range(rng.randint(0, 9)))
        assert found.fits(text) == any(holds(text, p) for p in phrases), (text, phrases)
    assert not found.fits(None) and not Phrases([]).fits("x") and Phrases([" "]).fits("x")


@pytest.mark.parametrize("seed", range(8))
def test_boxes_against_brute_force(seed):
    rng = random.Random(seed)
    boxes = []
    for _ in range(rng.randint(1, 60)):
        south, west = rng.uniform(-90, 90), rng.uniform(-180, 180)
        size = rng.choice([0, 0.001, 0.3, 5, 100])
        boxes.append((south, west, south + rng.uniform(0, size), west + rng.uniform(0, size)))
    boxes.append((5.0, 5.0, 4.0, 6.0))
    lat = np.array([rng.choice([rng.uniform(-90, 90), boxes[0][0], boxes[0][2], float("nan")]) for _ in range(800)])
    lon = np.array([rng.choice([rng.uniform(-180, 180), boxes[0][1], boxes[0][3]]) for _ in range(800)])
    want = [any(s <= y <= n and w <= x <= e for s, w, n, e in boxes) for y, x in zip(lat, lon, strict=True)]
    assert Boxes(boxes).fit(lat, lon).tolist() == want
    assert not Boxes([]).fit(lat, lon).any()


def test_same_posts_as_the_plain_filter(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["Spark SQL", "spark_x", "SQL; spark", None, "", "naïve", "İstanbul x"]), i % 5, rng.choice(["en", "de", None]),
             rng.choice([None, 1.5, 40.0]), rng.choice([2.0, 3.0]), rng.choice(["none", "low", "medium"])) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, text string, author_id int, lang string, lat double, lon double, filter_level string")
    for options in (
        {"track": ["spark sql", "NAÏVE"]}, {"track": ["istanbul"]}, {"boxes": [(1, 1, 2, 2.5)]}, {"follow": [3], "track": ["spark"], "languages": ["en"]},
        {"boxes": [(1, 1, 2, 2.5)], "track": ["x"], "min_level": "low"}, {}, {"languages": ["de"]},
    ):
        many = sorted(r["id"] for r in stream_filter_many(df, **options).collect())
        assert many == sorted(r["id"] for r in stream_filter(df, **options).collect())
