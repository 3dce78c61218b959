import json

import pytest
from pyspark.sql import functions as F

from sieveworks.functions import text
from sieveworks.operators import inference

EDGES = ["\t a\x0b", "\x1cb\x1f", "\x85c\xa0", " d ", "​e", "İX", "ΑΣ", "", " , ,", None, "five, \x0cvow"]


def test_canonical_form_like_python(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(EDGES)], "i int, t string")
    got = {r.i: r.c for r in df.select("i", text.canonical(F.col("t")).alias("c")).collect()}
    for i, t in enumerate(EDGES):
        want = None if t is None else "|".join(sorted(x for x in (p.strip().lower() for p in t.split(",")) if x))
        assert got[i] == want


def test_reordered_recased_respaced_copies_share_a_hash(spark):
    texts = ["masterpiece, blue eyes, smile", " smile,BLUE EYES ,Masterpiece", "masterpiece, red eyes, smile", "smile, smile, blue eyes, masterpiece"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    a, b, c, d = (r.h for r in df.select(text.canonical_hash(F.col("t")).alias("h")).collect())
    assert a == b and len({a, c, d}) == 3 and len(a) == 16


@pytest.mark.parametrize(
    "limit, given, want, trimmed",
    [
        (20, "masterpiece, 1girl, smile", "masterpiece, 1girl, smile", False),
        (7, "masterpiece, best quality, 1girl, blonde hair, smile", "masterpiece, best quality, 1girl", True),
        (1, "one two three, four", "one two three", True),
        (20, " a ,b,, c ", "a, b, c", False),
        (20, " , ", " , ", False),
    ],
)
def test_trim(spark, limit, given, want, trimmed):
    r = spark.createDataFrame([(given,)], "t string").select(text.trim(F.col("t"), [(text.word_count, limit)]).alias("x")).first().x
    assert (r.text, r.trimmed) == (want, trimmed)


def test_trim_without_and_with_several_counters(spark):
    df = spark.createDataFrame([("a, b, c",)], "t string")
    assert df.select(text.trim(F.col("t"), []).alias("x")).first().x.trimmed is False
    both = [(text.word_count, 5), (lambda c: F.length(c), 4)]
    assert df.select(text.trim(F.col("t"), both).alias("x")).first().x.text == "a, b"
    assert (text.max_length(None), text.max_length(10**30), text.max_length(64)) == (77, 77, 64)


COMPONENTS = dict(subject="1girl, solo", face_shape="round face", eyes="blue eyes", nose="small nose", mouth="small mouth", hair_color="blonde hair", hair_style="long hair", expression="smile", accessories="", style_modifiers=["masterpiece"], lighting="natural lighting", background="simple background")
NEGATIVES = {"base_negative": "low", "conditional_negatives": {"face_focus": ["extra limbs"], "detailed_eyes": ["bad eyes"], "quality": ["bad hands"], "anti_side_view": ["from side"], "extreme_closeup": ["extreme close-up"]}}


def one(spark, **changed):
    schema = ", ".join(f"{k} {'array<string>' if k == 'style_modifiers' else 'string'}" for k in COMPONENTS)
    return spark.createDataFrame([tuple({**COMPONENTS, **changed}.values())], schema)


def test_positive(spark):
    got = one(spark, style_modifiers=["solo", "masterpiece", "close-up", "best quality"], accessories="earrings").select(text.positive()).first()[0]
    assert got == "masterpiece, best quality, solo, close-up, 1girl, blonde hair, long hair, blue eyes, round face, small nose, small mouth, smile, earrings, frontal face, looking at viewer, natural lighting, simple background"
    got = one(spark, lighting="", background="").select(text.positive()).first()[0]
    assert got.endswith("smile, frontal face, looking at viewer")


@pytest.mark.parametrize(
    "changed, want",
    [
        ({}, "low, bad hands, from side, extreme close-up"),
        ({"style_modifiers": ["close-up", "detailed eyes"]}, "low, extra limbs, bad eyes, bad hands, from side, extreme close-up"),
        ({"eyes": " Heterochromia "}, "low, bad eyes, bad hands, from side, extreme close-up"),
    ],
)
def test_negative(spark, changed, want):
    assert one(spark, **changed).select(text.negative(NEGATIVES)).first()[0] == want
    assert one(spark, **changed).select(text.negative({"base_negative": "b"})).first()[0] == "b"


def test_json_lines_like_python(spark):
    values = ["plain", "é", "😀 \"q\" \\ \n \x01", "", None, "中"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, id string")
    got = [r.x for r in df.orderBy("n").select(text.json_line(["id"], ["n"], ["id", "n"]).alias("x")).collect()]
    assert [json.loads(x) for x in got] == [{"id": v, "n": i} for i, v in enumerate(values)]
    for i in (0, 1, 3, 4, 5):
        assert got[i] == json.dumps({"id": values[i], "n": i})
    assert all(x.isascii() for x in got)


def test_batches_shrink_when_memory_runs_out():
    calls = []

    def model(rows):
        calls.append(len(rows))
        if len(rows) > 2:
            raise RuntimeError("CUDA out of memory")
        return rows

    def failing(rows):
        raise RuntimeError("out of memory")

    got = [r for part, _ in inference.in_batches(list(range(9)), 8, model) for r in part]
    assert got == list(range(9)) and calls == [8, 4, 2, 2, 2, 2, 1]
    with pytest.raises(RuntimeError):
        list(inference.in_batches([1], 4, failing))
    with pytest.raises(KeyError):
        list(inference.in_batches([1, 2], 2, lambda rows: {}["x"]))


@pytest.mark.parametrize("resolution, gib, fused, want", [(1024, 10.0, True, 1), (1024, 24.0, True, 4), (1024, 16.0, False, 2), (512, 5.0, False, 1), (768, 30.0, True, 6)])
def test_batch_cap(spark, resolution, gib, fused, want):
    df = spark.createDataFrame([(resolution, gib, fused)], "r int, g double, f boolean")
    assert df.select(inference.batch_cap(F.col("r"), F.col("g"), F.col("f"))).first()[0] == want
