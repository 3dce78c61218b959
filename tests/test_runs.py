import dataclasses
import json
import tarfile

import pytest
from pyspark.sql import functions as F

from sieveworks import __main__ as cli
from sieveworks import queries
from sieveworks.functions import png
from sieveworks.operators import gates, inference, shards
from sieveworks.plans import generate, images
from sieveworks.sources import config, jsonl, progress, tar
from sieveworks.streaming import inference as stream

NEGATIVES = {"base_negative": "low, blurry", "conditional_negatives": {"quality": ["bad hands"]}}
LOOSE = {"eyes": 3, "never": 0}


def rows_of(run):
    return sorted((r.shard_id, r.record_idx, r.id, r.positive_prompt, r.negative_prompt, r.seed) for r in run.records.collect())


def test_generation_is_deterministic_and_complete(spark):
    first = generate.generate(spark, queries.VOCABULARY, NEGATIVES, 42, 103, 2)
    rows = rows_of(first)
    assert rows == rows_of(generate.generate(spark, queries.VOCABULARY, NEGATIVES, 42, 103, 2))
    assert rows != rows_of(generate.generate(spark, queries.VOCABULARY, NEGATIVES, 43, 103, 2))
    assert [sum(r[0] == s for r in rows) for s in (0, 1)] == [52, 51]
    assert [r[2] for r in rows[:2]] == ["s0000-r0000", "s0000-r0001"]
    assert len({r[3] for r in rows}) == len({r[5] for r in rows}) == 103
    assert all(x.strip() for r in rows for x in r[2:5])


def tiny(n):
    """Few combinations, so that duplicates and exhaustion occur."""
    out = {c: {"options": [{"value": f"{c} {i}", "weight": 1} for i in range(n if c in ("eyes", "mouth") else 1)]} for c in config.COMPONENTS}
    out["style_modifiers"] = {"options": [{"value": "s1", "weight": 1}, {"value": "s2", "weight": 1}, {"value": "s3", "weight": 1}]}
    return out


def test_tiny_vocabulary_has_duplicates_over_shards(spark):
    run = generate.generate(spark, tiny(4), NEGATIVES, 1, 12, 3)
    rows = rows_of(run)
    assert len({r[3] for r in rows}) == 12
    assert {r.reason: r.n for r in run.rejected.collect()}.get("duplicate", 0) > 0


def test_exhaustion_raises(spark):
    with pytest.raises(RuntimeError, match="unable to fill"):
        generate.generate(spark, tiny(2), NEGATIVES, 1, 5, 1)


def test_publish_and_guard(spark, tmp_path):
    run = generate.generate(spark, queries.VOCABULARY, NEGATIVES, 7, 100, 2)
    save = lambda name, text: (tmp_path / name).write_text(text)
    manifest = generate.publish(run, str(tmp_path), 7, 100, [queries.VOCABULARY, NEGATIVES], save, LOOSE)
    assert json.loads((tmp_path / "manifest.json").read_text()) == manifest and manifest["total_records"] == 100
    report = json.loads((tmp_path / "diversity_report.json").read_text())
    assert report["thresholds"] == LOOSE and report["unique_counts"]["never"] == 0
    counts = list(report["per_feature_distribution"]["eyes"].values())
    assert counts == sorted(counts, reverse=True) and sum(counts) == 100
    lines = [json.loads(x) for f in sorted((tmp_path / "prompts.jsonl").glob("part-*")) for x in f.read_text().splitlines()]
    assert [x["id"] for x in lines] == [r[2] for r in rows_of(run)] and list(lines[0]) == list(jsonl.ORDER)
    (tmp_path / "manifest.json").unlink()
    with pytest.raises(generate.FinalizationError, match="Diversity"):
        generate.publish(run, str(tmp_path), 7, 100, [{}], save, {"eyes": 999})
    with pytest.raises(generate.FinalizationError, match="count"):
        generate.publish(run, str(tmp_path), 7, 101, [{}], save, LOOSE)
    assert not (tmp_path / "manifest.json").exists()


@pytest.fixture(scope="module")
def prompts(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("prompts") / "p"
    run = generate.generate(spark, queries.VOCABULARY, NEGATIVES, 3, 20, 2)
    jsonl.write_records(run.records, str(folder))
    return str(folder)


@pytest.fixture
def run_config(prompts, tmp_path):
    return config.RunConfig(prompts_path=prompts, workspace_dir=str(tmp_path / "w"), shards_dir=str(tmp_path / "s"), report_dir=str(tmp_path), shard_size=10, target_count=20, resolution=16)


def test_image_run_and_resume(spark, run_config, tmp_path):
    report = images.run(spark, run_config)
    assert report["validation_passed"] and report["shard_count"] == 2 and "failure_breakdown" not in report
    with tarfile.open(tmp_path / "s" / tar.shard_name(1)) as t:
        names = t.getnames()
    assert names[:2] == ["s0001-r0000.png", "s0001-r0000.json"] and len(names) == 20
    before = images.workspace(spark, run_config).count()
    assert images.run(spark, run_config)["validation_passed"] and images.workspace(spark, run_config).count() == before
    assert not list((tmp_path / "s").glob(".*.tmp"))


def test_unfinished_shards_are_told_and_resumed(spark, run_config):
    rows = images.records(spark, run_config).where("shard_id = 0 OR idx < 4")
    inference.generate(rows, dataclasses.asdict(run_config)).write.partitionBy("shard_id").parquet(run_config.workspace_dir)
    assert images.package(spark, run_config) == [1]
    found = {g["name"]: g for g in images.validate(spark, run_config)}
    assert [n for n, g in found.items() if not g["passed"]] == ["count", "coverage", "completion"]
    assert found["coverage"]["failures"][0].startswith("Missing 10 samples: s0001-r0000")
    images.generate(spark, run_config)
    assert images.package(spark, run_config) == [] and images.workspace(spark, run_config).count() == 20


def test_plan_stops_at_the_first_violation(spark, tmp_path, run_config):
    def plan(lines, **changed):
        folder = tmp_path / "bad"
        folder.mkdir(exist_ok=True)
        (folder / "a.jsonl").write_text("\n".join(lines))
        return images.plan(spark, dataclasses.replace(run_config, prompts_path=str(folder), **{"target_count": 3, "shard_size": 2, **changed}))

    def line(i, **changed):
        value = {"id": f"s{i // 2:04d}-r{i % 2:04d}", "positive_prompt": "p", "negative_prompt": "n", "shard_id": i // 2, "seed": i, **changed}
        return json.dumps({k: v for k, v in value.items() if v != "gone"})

    good = [line(0), "", " \t", line(1), line(2), "{damaged"]
    assert plan(good)["sample_id_range"] == ["s0000-r0000", "s0001-r0000"]
    for lines, message in (
        (good[:4], "Expected 3 records, got 2"),
        ([line(0), line(0, seed="gone"), line(2)], "Record 1 missing fields: seed"),
        ([line(0), line(1, id="s0000-r0000", seed=0), line(2)], "Duplicate sample ID: s0000-r0000"),
        ([line(0), line(1, seed=0), line(2)], "Duplicate seed at record 1: 0"),
        ([line(0), line(1), line(2, shard_id=0)], "Expected 2 shards, found 1"),
        ([line(0), line(1, shard_id=1), line(2)], "Shard 0: expected 2 records, got 1"),
    ):
        with pytest.raises(images.PlanError, match=message):
            plan(lines)
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        plan([line(0), "{damaged", line(2)])


def test_gates_find_each_damage(spark):
    good = png.render("x", 1, 16)
    meta = json.dumps({k: 1 for k in gates.METADATA})
    rows = [("s0000-r0000", good, meta), ("s0000-r0001", good[:-20], meta), ("s0000-r0002", None, None), ("s0000-r0003", png.render("x", 1, 8), '{"seed": 1}'), ("s0000-r0004", b"GIF", "[]"), ("s0009-r0000", good[:60] + b"\0" + good[61:], meta)]
    found = {r["name"]: r for r in gates.validate(spark.createDataFrame(rows, "id string, png binary, json string"), 6, 6, 16).collect()}
    assert not any(found[n].passed for n in ("image_integrity", "metadata", "coverage", "completion")) and found["count"].passed
    told = found["image_integrity"].failures
    assert len(told) == 5 and "missing PNG data" in told[1] and "size 8x8, expected 16x16" in told[2]
    assert len(found["metadata"].failures) == 3
    assert found["coverage"].failures == ["Missing 1 samples: s0000-r0005", "Extra 1 samples: s0009-r0000"]
    report = gates.run_report([r.asDict() for r in found.values()], 6, 6, "m", "now", 3.0)
    assert report["throughput_samples_per_sec"] == 2.0 and set(report["failure_breakdown"]) == {"image_integrity", "metadata", "coverage"}


def test_tar_pairs_members_and_last_archive_wins(spark, tmp_path):
    df = spark.createDataFrame([(1, 0, "a", b"1", "{}"), (1, 1, "only-json", None, "{}"), (1, 2, "only-png", b"2", None), (2, 0, "a", b"3", "{}")], "shard_id int, idx int, id string, png binary, json string")
    assert tar.write(df, str(tmp_path / "t")).count() == 2
    got = {r.id: (bytes(r.png), r.json) for r in tar.samples(spark, str(tmp_path / "t")).collect()}
    assert got == {"a": (b"3", "{}"), "only-png": (b"2", None)}
    all_of = tar.samples(spark, str(tmp_path / "t"), last_wins=False)
    assert all_of.count() == 3
    assert not gates.repeats_gate(all_of).first().passed


def test_progress(spark, tmp_path):
    path = str(tmp_path / "p")
    assert progress.load(spark, path).count() == 0
    ids = spark.createDataFrame([(1,), (2,)], "id long")
    progress.append(ids, "shard", path)
    progress.append(ids, "shard", path)
    assert progress.load(spark, path).count() == 2
    todo = spark.createDataFrame([(1,), (3,), (None,)], "id long")
    assert sorted(progress.pending(todo, progress.load(spark, path), "shard").collect(), key=str) == [(3,), (None,)]
    assert progress.pending(todo, progress.load(spark, path), "sample").count() == 3


def test_stream_writes_each_sample_once(spark, prompts, tmp_path):
    settings = dataclasses.asdict(config.RunConfig(resolution=8))
    for _ in range(2):
        stream.start(spark, prompts, str(tmp_path / "o"), str(tmp_path / "c"), settings, files=1).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "o"))
    assert got.count() == got.select("id").distinct().count() == 20


def test_vocabulary_errors(tmp_path):
    with pytest.raises(ValueError, match="missing component"):
        config.check_vocabulary({})
    full = tiny(1)
    for damage, message in (({"eyes": {}}, "no options"), ({"eyes": {"options": []}}, "empty options")):
        with pytest.raises(ValueError, match=message):
            config.check_vocabulary(full | damage)
    (tmp_path / "vocab.yaml").write_text(json.dumps(full))
    assert config.load_vocabulary(tmp_path) == full
    (tmp_path / "run.yaml").write_text('{"resolution": 5, "unknown": 1}')
    assert config.RunConfig.load(tmp_path / "run.yaml").resolution == 5 and config.RunConfig.load(None).resolution == 1024


def test_command_line():
    p = cli.parser().parse_args
    assert cli.prompt_sizes(p(["prompts", "--config-dir", "c"])) == (100_000, 100, "output/full")
    assert cli.prompt_sizes(p(["prompts", "--config-dir", "c", "--pilot", "--count", "5"])) == (5, 1, "output/pilot")
    assert cli.prompt_sizes(p(["prompts", "--config-dir", "c", "--pilot", "--output-dir", "x"]))[2] == "x"
    c = cli.image_config(p(["images", "plan", "--pilot", "--output-path", "o", "--prompts-path", "q"]))
    assert (c.target_count, c.shard_size, c.shards_dir, c.prompts_path) == (1, 1, "o/shards", "q")


def test_lattice_beyond_four_digits(spark):
    got = [r.id for r in shards.lattice(spark, 3, 1).select(shards.sample_id(F.col("shard_id") + 9999, F.lit(12345)).alias("id")).orderBy("id").collect()]
    assert got == ["s10000-r12345", "s10001-r12345", "s9999-r12345"]
    assert [r.wanted for r in shards.balanced(spark, 3, 5).orderBy("shard_id").collect()] == [1, 1, 1, 0, 0]
    with pytest.raises(ZeroDivisionError):
        shards.balanced(spark, 3, 0)
