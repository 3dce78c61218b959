"""Queries of the engine's own operators over the supplied tables, each with the SQL that gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveworks.functions import draws, png, text
from sieveworks.operators import dedup, diversity, gates, inference, rules, shards, telemetry
from sieveworks.plans import generate
from sieveworks.session import shared_folder, written
from sieveworks.sources import jsonl, progress, tar

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SPACE = r"E' \t\n\r'"
TOKENS = f"list_transform(string_split(text, ','), lambda x: lower(trim(x, {SPACE})))"
CANONICAL = f"array_to_string(list_sort(list_filter({TOKENS}, lambda x: x <> '')), '|')"
HASH = f"substr(sha256({CANONICAL}), 1, 16)"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def uniform_sql(key: str) -> str:
    return f"((('0x' || substr(sha256({key}), 1, 8))::BIGINT + 0.5) / 4294967296.0)"


def list_sql(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


# --- Canonical form and duplicates -------------------------------------------------------------------------------


@query(f"SELECT doc_id, {HASH} AS canon_hash FROM documents")
def canonical_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.canonical_hash(F.col("text"), plain=True).alias("canon_hash"))


@query(f"SELECT min(doc_id) AS doc_id, canon_hash FROM (SELECT doc_id, {HASH} AS canon_hash FROM documents) GROUP BY canon_hash")
def near_dedup_keep_first(spark, sf_dir):
    return dedup.keep_first(canonical_hash(spark, sf_dir), "canon_hash", ["doc_id"])


@query(f"SELECT {HASH} AS canon_hash, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def dup_groups(spark, sf_dir):
    return dedup.duplicates(canonical_hash(spark, sf_dir), "canon_hash")


SHARDED = f"SELECT doc_id % 4 AS shard_id, doc_id // 4 AS attempt, CASE WHEN len(string_split(text, ',')) >= 4 THEN {HASH} END AS hash FROM documents"


def _sharded(spark, sf_dir):
    rows = table(spark, sf_dir, "documents")
    canon = F.when(F.size(F.split("text", ",", -1)) >= 4, text.canonical_hash(F.col("text"), plain=True))
    return rows.select((F.col("doc_id") % 4).alias("shard_id"), F.expr("doc_id div 4").alias("attempt"), canon.alias("hash"))


def _wanted(spark, sf_dir):
    """Each shard wants half of its candidates."""
    return table(spark, sf_dir, "documents").groupBy((F.col("doc_id") % 4).alias("shard_id")).agg(F.expr("count(*) div 2").alias("wanted"))


def _sequential_sql(n_shards: int) -> str:
    """One shard after another: what is consumed of each depends on what those before have accepted."""
    out = [f"WITH c AS ({SHARDED}), w AS (SELECT shard_id, count(*) // 2 AS wanted FROM c GROUP BY shard_id)"]
    for i in range(n_shards):
        seen = " UNION ALL ".join(f"SELECT hash FROM a{j}" for j in range(i)) or "SELECT NULL AS hash WHERE false"
        out.append(f"f{i} AS (SELECT shard_id, hash, min(attempt) AS attempt FROM c WHERE shard_id = {i} AND hash IS NOT NULL AND hash NOT IN ({seen}) GROUP BY shard_id, hash)")
        out.append(f"a{i} AS (SELECT *, max(attempt) OVER () AS cut FROM (SELECT *, row_number() OVER (ORDER BY attempt) - 1 AS record_idx FROM f{i}) WHERE record_idx < (SELECT wanted FROM w WHERE shard_id = {i}))")
    return ", ".join(out) + " " + " UNION ALL ".join(f"SELECT shard_id, attempt, hash, record_idx, cut FROM a{i}" for i in range(n_shards))


@query(_sequential_sql(4))
def sequential_dedup(spark, sf_dir):
    """What a run over four shards, one after another, accepts."""
    cuts, accepted = dedup.consumed(_sharded(spark, sf_dir), _wanted(spark, sf_dir))
    return accepted.join(cuts, "shard_id").select("shard_id", "attempt", "hash", "record_idx", "cut")


@query(f"""
WITH c AS ({SHARDED}), g AS (SELECT shard_id, attempt - lag(attempt, 1, -1) OVER (PARTITION BY shard_id ORDER BY attempt) - 1 AS gap FROM c WHERE hash IS NOT NULL)
SELECT shard_id, CAST(sum(gap // 2) AS BIGINT) AS exhausted FROM g GROUP BY shard_id""")
def exhausted_slots(spark, sf_dir):
    return dedup.exhausted_slots(_sharded(spark, sf_dir).where("hash IS NOT NULL"), 2)


# --- Rules and lints ---------------------------------------------------------------------------------------------

BANNED = ("the", "in", "to", "of", "la", "de", "der")
CONTRADICTION = (("and", "is"),)
POSITIVE_SQL = f"list_concat(list_transform(list_sort(list_filter({list_sql(BANNED)}, lambda b: list_contains({TOKENS}, b))), lambda b: 'banned token in positive prompt: ''' || b || ''''), CASE WHEN len({TOKENS}) < 8 THEN ['too few tokens: ' || len({TOKENS}) || ' < 8'] ELSE [] END)"
SEMANTIC_SQL = f"(list_contains({TOKENS}, 'and') AND list_contains({TOKENS}, 'is'))"


@query(f"""
SELECT reason, count(*) AS n FROM (SELECT CASE WHEN coalesce(lang, '') = '' OR coalesce(source, '') = '' THEN 'lint_components'
  WHEN len({POSITIVE_SQL}) > 0 THEN 'lint_positive' WHEN {SEMANTIC_SQL} THEN 'lint_semantic' END AS reason FROM documents) WHERE reason IS NOT NULL GROUP BY reason""")
def reject_reason_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").withColumn("tokens", text.tokens(F.col("text"), plain=True))
    reason = rules.first_reason(
        {
            "lint_components": (F.coalesce("lang", F.lit("")) == "") | (F.coalesce("source", F.lit("")) == ""),
            "lint_positive": F.size(rules.positive_lint(F.col("tokens"), BANNED)) > 0,
            "lint_semantic": F.size(rules.semantic_lint(F.col("tokens"), CONTRADICTION)) > 0,
        }
    )
    return rules.reason_counts(rows.select(reason.alias("reason")))


@query(f"SELECT doc_id, array_to_string(list_concat({POSITIVE_SQL}, CASE WHEN {SEMANTIC_SQL} THEN ['contradiction: and with is'] ELSE [] END), '; ') AS violations FROM documents")
def lint_violations(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").withColumn("tokens", text.tokens(F.col("text"), plain=True))
    found = F.concat(rules.positive_lint(F.col("tokens"), BANNED), rules.semantic_lint(F.col("tokens"), CONTRADICTION))
    return rows.select("doc_id", F.array_join(found, "; ").alias("violations"))


EXCLUSIONS = (("p_brand", "Brand#11", "p_size", "7"), ("p_brand", "Brand#23", "p_type", "PROMO"), ("p_type", "ECONOMY", "p_size", "1"), ("p_type", "STANDARD", "p_size", "50"), ("unknown", "x", "p_size", "1"))
EXCLUSION_COLUMNS = ("component_a", "value_a", "component_b", "value_b")


def _parts(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", F.col("p_size").cast("string").alias("p_size"))


@query("""
SELECT p_partkey FROM part p WHERE NOT EXISTS (SELECT 1 FROM (VALUES """ + ", ".join(str(e) for e in EXCLUSIONS) + """) AS r(component_a, value_a, component_b, value_b)
  WHERE CASE component_a WHEN 'p_brand' THEN p.p_brand WHEN 'p_type' THEN p.p_type WHEN 'p_size' THEN p.p_size::VARCHAR END = value_a
    AND CASE component_b WHEN 'p_brand' THEN p.p_brand WHEN 'p_type' THEN p.p_type WHEN 'p_size' THEN p.p_size::VARCHAR END = value_b)""")
def compat_exclusion_anti(spark, sf_dir):
    table_of_rules = spark.createDataFrame(list(EXCLUSIONS), ", ".join(f"{c} string" for c in EXCLUSION_COLUMNS))
    return rules.compatible(_parts(spark, sf_dir), table_of_rules, ["p_brand", "p_type", "p_size"]).select("p_partkey")


@query(ORACLES["compat_exclusion_anti"])
def compat_exclusion_expression(spark, sf_dir):
    listed = [dict(zip(EXCLUSION_COLUMNS, e)) for e in EXCLUSIONS]
    rows = _parts(spark, sf_dir)
    return rows.where(~rules.incompatible(listed, rows.columns)).select("p_partkey")


@query(f"""
SELECT conv_id, turn, array_to_string(list_filter([CASE WHEN role IS NULL THEN 'missing field: role' END, CASE WHEN trim(role, {SPACE}) = '' THEN 'empty field: role' END,
  CASE WHEN text IS NULL THEN 'missing field: text' END, CASE WHEN trim(text, {SPACE}) = '' THEN 'empty field: text' END], lambda m: m IS NOT NULL), '; ') AS violations FROM conversations""")
def record_field_lint(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.array_join(rules.field_lint(("role", "text"), ("role", "text")), "; ").alias("violations"))


# --- Diversity ---------------------------------------------------------------------------------------------------

DISTINCT_SQL = """
SELECT 'lang' AS feature, count(DISTINCT lang) AS n_unique FROM documents UNION ALL SELECT 'source', count(DISTINCT source) FROM documents
UNION ALL SELECT 'event_type', count(DISTINCT event_type) FROM events UNION ALL SELECT 'p_brand', count(DISTINCT p_brand) FROM part UNION ALL SELECT 'p_type', count(DISTINCT p_type) FROM part"""


@query(DISTINCT_SQL)
def feature_distinct(spark, sf_dir):
    out = diversity.distinct_values(table(spark, sf_dir, "documents"), ["lang", "source"])
    out = out.unionByName(diversity.distinct_values(table(spark, sf_dir, "events"), ["event_type"]))
    return out.unionByName(diversity.distinct_values(table(spark, sf_dir, "part"), ["p_brand", "p_type"]))


@query("""
SELECT feature, value, n, row_number() OVER (PARTITION BY feature ORDER BY n DESC, first) AS place FROM (
  SELECT 'event_type' AS feature, event_type AS value, count(*) AS n, min(event_id) AS first FROM events GROUP BY event_type)""")
def feature_histogram(spark, sf_dir):
    return diversity.histogram(table(spark, sf_dir, "events"), ["event_type"], ["event_id"])


LIMITS = {"lang": 4, "source": 25, "never_seen": 1}
CHECK_SQL = """
SELECT t.feature, coalesce(n_unique, 0) >= required AS passed, coalesce(n_unique, 0) AS n_unique, required FROM (VALUES ('lang', 4), ('source', 25), ('never_seen', 1)) AS t(feature, required)
LEFT JOIN (SELECT 'lang' AS feature, count(DISTINCT lang) AS n_unique FROM documents UNION ALL SELECT 'source', count(DISTINCT source) FROM documents) u USING (feature)"""


@query(CHECK_SQL)
def diversity_thresholds(spark, sf_dir):
    return diversity.check(table(spark, sf_dir, "documents"), LIMITS)


@query(f"SELECT bool_and(passed) AS all_met FROM ({CHECK_SQL})")
def all_thresholds_met(spark, sf_dir):
    return diversity.all_met(diversity_thresholds(spark, sf_dir))


@query("SELECT lang, source, count(*) AS n, CAST(grouping_id(lang, source) AS BIGINT) AS level FROM documents GROUP BY CUBE (lang, source)")
def cross_tab(spark, sf_dir):
    return diversity.cross_table(table(spark, sf_dir, "documents"), "lang", "source")


@query("SELECT doc_id, lang, source FROM documents QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) <= 5")
def quota_backpressure(spark, sf_dir):
    return diversity.within_quota(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), ["lang", "source"], ["doc_id"], 5)


# --- Shards and draws --------------------------------------------------------------------------------------------


@query("SELECT range AS shard_id, CAST(100003 // 7 + CASE WHEN range < 100003 % 7 THEN 1 ELSE 0 END AS BIGINT) AS wanted FROM range(7)")
def shard_plan_balanced(spark, sf_dir):
    return shards.balanced(spark, 100_003, 7)


@query("SELECT range AS shard_id, CAST(least(1000, 100003 - range * 1000) AS BIGINT) AS wanted FROM range(101)")
def shard_plan_packed(spark, sf_dir):
    return shards.packed(spark, 100_003, 1000)


@query("SELECT range // 1000 AS shard_id, range % 1000 AS idx, format('s{:04d}-r{:04d}', range // 1000, range % 1000) AS id FROM range(100003)")
def expected_ids(spark, sf_dir):
    return shards.lattice(spark, 100_003, 1000)


@query("SELECT range AS shard_id, ('0x' || substr(sha256('42:' || range), 1, 8))::BIGINT AS seed FROM range(100000)")
def shard_seed(spark, sf_dir):
    return spark.range(100_000).select(F.col("id").alias("shard_id"), draws.shard_seed(F.lit(42), F.col("id")).alias("seed"))


@query("SELECT o_orderkey, ('0x' || substr(sha256('42:' || o_custkey || ':' || o_orderkey), 1, 8))::BIGINT % 2147483649 AS seed FROM orders")
def attempt_seed(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", draws.sub_seed(F.lit(42), F.col("o_custkey"), F.col("o_orderkey")).alias("seed"))


OPTIONS = [("red", 1.0), ("green", 0.5), ("blue", 0.25), ("", 0.25), ("grey", 2.0)]


def _draw_sql(key: str) -> str:
    out, total = "CASE", sum(w for _, w in OPTIONS)
    end = 0.0
    for v, w in OPTIONS:
        end += w
        out += f" WHEN {end} > {uniform_sql(key)} * {total} THEN '{v}'"
    return out + " END"


@query(f"SELECT o_orderkey, {_draw_sql('o_orderkey::VARCHAR')} AS value FROM orders")
def weighted_draw(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", draws.weighted(F.col("o_orderkey"), OPTIONS).alias("value"))


STYLES = [("soft", 1.0), ("sharp", 0.9), ("grainy", 0.2), ("bright", 0.4), ("dark", 0.4), ("flat", 0.7), ("wide", 1.5)]


@query(f"""
WITH d AS (SELECT c_custkey, 3 + CAST(floor({uniform_sql("c_custkey || ':n'")} * 4) AS INTEGER) AS n,
  list_transform(list_sort([{", ".join("{'t': -ln(" + uniform_sql(f"c_custkey || ':{v}'") + f") / {w}, 'v': '{v}'" + "}" for v, w in STYLES)}]), lambda r: r.v) AS order_of FROM customer)
SELECT c_custkey, array_to_string(list_sort(order_of[1:n]), ', ') AS styles FROM d""")
def weighted_subset(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(draws.weighted_subset(F.col("c_custkey"), STYLES), ", ").alias("styles"))


# --- Assembling --------------------------------------------------------------------------------------------------

NEGATIVES = {"base_negative": "worst, low", "conditional_negatives": {"face_focus": ["limbs"], "detailed_eyes": ["bad eyes", "odd eyes"], "quality": ["bad hands"], "anti_side_view": [], "extreme_closeup": ["cropped"]}}


def _as_components(spark, sf_dir):
    """Parts as components: styles from size and type, with repeats and empty parts."""
    styles = F.array(F.when(F.col("p_size") % 3 == 0, "close-up").otherwise("solo"), F.when(F.col("p_size") % 2 == 0, "masterpiece").otherwise(" Detailed Eyes "), F.lower("p_type"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        styles.alias("style_modifiers"),
        F.concat(F.lit("1girl, "), F.when(F.col("p_size") % 5 == 0, "solo").otherwise("smile")).alias("subject"),
        F.lit("round").alias("face_shape"),
        F.when(F.col("p_size") % 7 == 0, "Glowing Eyes").otherwise("blue eyes").alias("eyes"),
        F.lower("p_brand").alias("nose"),
        F.lit("small").alias("mouth"),
        F.lower("p_brand").alias("hair_color"),
        F.lit("long").alias("hair_style"),
        F.lit("smile").alias("expression"),
        F.when(F.col("p_size") % 4 == 0, "hat").otherwise("").alias("accessories"),
        F.when(F.col("p_size") % 6 == 0, "soft light").otherwise("").alias("lighting"),
        F.lit("").alias("background"),
    )


STYLES_SQL = "[CASE WHEN p_size % 3 = 0 THEN 'close-up' ELSE 'solo' END, CASE WHEN p_size % 2 = 0 THEN 'masterpiece' ELSE ' Detailed Eyes ' END, lower(p_type)]"
EYES_SQL = "CASE WHEN p_size % 7 = 0 THEN 'Glowing Eyes' ELSE 'blue eyes' END"


@query(f"""
WITH c AS (SELECT p_partkey, {STYLES_SQL} AS st, p_size, lower(p_brand) AS brand, {EYES_SQL} AS eyes FROM part),
a AS (SELECT p_partkey, list_concat(list_filter(st, lambda s: list_contains({list_sql(text.QUALITY_TAGS)}, s)), list_filter(st, lambda s: NOT list_contains({list_sql(text.QUALITY_TAGS)}, s)),
  ['1girl', CASE WHEN p_size % 5 = 0 THEN 'solo' ELSE 'smile' END, brand, 'long', eyes, 'round', brand, 'small', 'smile'],
  CASE WHEN p_size % 4 = 0 THEN ['hat'] ELSE [] END, ['frontal face', 'looking at viewer'], CASE WHEN p_size % 6 = 0 THEN ['soft light'] ELSE [] END) AS l FROM c)
SELECT p_partkey, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ', ') AS positive_prompt FROM a""")
def assemble_positive(spark, sf_dir):
    return _as_components(spark, sf_dir).select("p_partkey", text.positive().alias("positive_prompt"))


@query(f"""
SELECT p_partkey, 'worst, low' || CASE WHEN p_size % 3 = 0 THEN ', limbs' ELSE '' END || CASE WHEN p_size % 2 <> 0 OR p_size % 7 = 0 THEN ', bad eyes, odd eyes' ELSE '' END || ', bad hands, cropped' AS negative_prompt FROM part""")
def assemble_negative(spark, sf_dir):
    return _as_components(spark, sf_dir).select("p_partkey", text.negative(NEGATIVES).alias("negative_prompt"))


#: A vocabulary of our own for the production query.
VOCABULARY = {
    name: {"options": [{"value": f"{word} {name.split('_')[0]}" if word else "", "weight": round(1 / (i + 1), 3)} for i, word in enumerate(words)]}
    for name, words in {
        "subject": ("young", "old", "tall"),
        "face_shape": ("round", "oval", "square", "long"),
        "eyes": tuple("amber azure black blue brown bronze clear copper cyan dark deep dim golden green grey hazel indigo ivory jade lilac mint opal pale".split()),
        "nose": ("small", "straight", "broad"),
        "mouth": ("small", "wide", "thin"),
        "hair_color": tuple("ash auburn black blonde brown copper red silver white grey chestnut".split()),
        "hair_style": tuple("bob braided curly layered long messy ponytail short straight wavy tied".split()),
        "expression": tuple("calm curious gentle happy pensive proud sad shy stern".split()),
        "accessories": ("", "round", "woollen", "golden", "silver", "plain"),
        "style_modifiers": ("soft", "sharp", "bright", "muted", "grainy", "warm", "cold", "flat"),
        "lighting": ("", "morning", "evening", "studio"),
        "background": ("", "plain", "forest", "city"),
    }.items()
} | {"compatibility_exclusions": [{"component_a": "eyes", "value_a": "dark eyes", "component_b": "expression", "value_b": "happy expression"}]}


@query()
def generate_prompts(spark, sf_dir):
    """The reference's full-run size: 100,000 records in 100 shards."""
    run = generate.generate(spark, VOCABULARY, NEGATIVES, 42, 100_000, 100)
    return run.records.select("shard_id", "record_idx", "id", "positive_prompt", "negative_prompt", "seed")


@query()
def rejection_telemetry(spark, sf_dir):
    return generate.generate(spark, VOCABULARY, NEGATIVES, 42, 20_000, 20).rejected


# --- Plan validation and coverage --------------------------------------------------------------------------------


def _lines(spark, sf_dir):
    """Documents as lines of a plan, with repeated ids and seeds and missing keys."""
    rows = table(spark, sf_dir, "documents")
    keys = F.when(F.col("doc_id") % 97 == 5, F.array(F.lit("id"), F.lit("shard_id"), F.lit("positive_prompt"))).otherwise(F.array(*[F.lit(f) for f in rules.FIELDS]))
    return rows.select(
        F.col("doc_id").alias("line_no"),
        keys.alias("keys"),
        shards.sample_id(F.expr("doc_id div 100"), F.expr("doc_id % 100 - CASE WHEN doc_id % 100 = 7 THEN 1 ELSE 0 END")).alias("id"),
        (F.col("doc_id") - F.when(F.col("doc_id") % 50 == 3, 2).otherwise(0)).alias("seed"),
        F.expr("doc_id div 100 + CASE WHEN doc_id % 333 = 1 THEN 1 ELSE 0 END").alias("shard_id"),
    )


LINES_SQL = "SELECT doc_id AS line_no, doc_id % 97 = 5 AS bad, format('s{:04d}-r{:04d}', doc_id // 100, doc_id % 100 - CASE WHEN doc_id % 100 = 7 THEN 1 ELSE 0 END) AS id, doc_id - CASE WHEN doc_id % 50 = 3 THEN 2 ELSE 0 END AS seed, doc_id // 100 + CASE WHEN doc_id % 333 = 1 THEN 1 ELSE 0 END AS shard_id FROM documents"


@query(f"SELECT shard_id, count(*) AS n FROM ({LINES_SQL}) GROUP BY shard_id")
def shard_counts(spark, sf_dir):
    return shards.shard_counts(_lines(spark, sf_dir))


@query(f"""
WITH l AS ({LINES_SQL}), c AS (SELECT shard_id, count(*) AS n FROM l GROUP BY shard_id), p AS (SELECT range AS shard_id, least(100, 950 - range * 100) AS wanted FROM range(10))
SELECT 0 AS priority, CAST(-1 AS BIGINT) AS line_no, 0 AS check_no, 'Expected 950 records, got ' || count(*) AS message FROM l HAVING count(*) <> 950
UNION ALL SELECT 1, line_no, 1, 'Record ' || line_no || ' missing fields: negative_prompt, seed' FROM l WHERE bad
UNION ALL SELECT 1, line_no, 2, 'Duplicate sample ID: ' || id FROM l QUALIFY row_number() OVER (PARTITION BY id ORDER BY line_no) > 1
UNION ALL SELECT 1, line_no, 3, 'Duplicate seed at record ' || line_no || ': ' || seed FROM l QUALIFY row_number() OVER (PARTITION BY seed ORDER BY line_no) > 1
UNION ALL SELECT 2, CAST(-1 AS BIGINT), 0, 'Expected 10 shards, found ' || count(*) FROM c HAVING count(*) <> 10
UNION ALL SELECT 3, p.shard_id, 0, 'Shard ' || p.shard_id || ': expected ' || wanted || ' records, got ' || coalesce(n, 0) FROM p LEFT JOIN c USING (shard_id) WHERE coalesce(n, 0) <> wanted""")
def plan_violations(spark, sf_dir):
    return shards.plan_violations(_lines(spark, sf_dir), 950, 100)


@query(f"""
SELECT count(*) AS total_samples, count(DISTINCT shard_id) AS shard_count, CAST(100 AS BIGINT) AS shard_size, array_to_string(list_sort(list(DISTINCT shard_id)), ',') AS shard_ids,
  min(seed) AS min_seed, max(seed) AS max_seed, arg_min(id, line_no) AS first_id, arg_max(id, line_no) AS last_id FROM ({LINES_SQL})""")
def sample_manifest(spark, sf_dir):
    return shards.manifest(_lines(spark, sf_dir), 100).withColumn("shard_ids", F.array_join("shard_ids", ","))


@query("""
SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing' ELSE 'extra' END AS kind
FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT doc_id + 3 AS doc_id FROM labels) l ON d.doc_id = l.doc_id WHERE d.doc_id IS NULL OR l.doc_id IS NULL""")
def coverage_gaps(spark, sf_dir):
    return shards.gaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select((F.col("doc_id") + 3).alias("doc_id")), "doc_id")


# --- Tokens ------------------------------------------------------------------------------------------------------

WORDS_SQL = r"(len(list_filter(regexp_split_to_array(replace({}, ',', ' '), '\s+'), lambda w: w <> '')) + 2)"


@query(f"SELECT conv_id, turn, CAST({WORDS_SQL.format('text')} AS BIGINT) AS n_tokens FROM conversations")
def token_count(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.word_count(F.col("text")).cast("long").alias("n_tokens"))


TRIM_SQL = f"""
WITH t AS (SELECT conv_id, turn, text, list_filter(list_transform(string_split(text, ','), lambda x: trim(x, {SPACE})), lambda x: x <> '') AS tags FROM conversations),
c AS (SELECT conv_id, turn, text, tags, list_transform(tags, lambda x: len(list_filter(regexp_split_to_array(x, '\\s+'), lambda w: w <> ''))) AS costs FROM t),
k AS (SELECT *, list_max(list_filter(range(1, len(tags) + 1), lambda k: list_sum(costs[1:k]) + 2 <= 20)) AS best FROM c)
SELECT conv_id, turn, CASE WHEN len(tags) = 0 THEN text ELSE array_to_string(tags[1:coalesce(best, 1)], ', ') END AS trimmed_text,
  len(tags) > 0 AND (best IS NULL OR best < len(tags)) AS trimmed FROM k"""


@query(TRIM_SQL)
def token_trim(spark, sf_dir):
    cut = text.trim(F.col("text"), [(text.word_count, 20)], plain=True)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", cut.alias("cut")).select("conv_id", "turn", F.col("cut.text").alias("trimmed_text"), F.col("cut.trimmed").alias("trimmed"))


@query(f"SELECT trimmed, count(*) AS n, CAST(max({WORDS_SQL.format('trimmed_text')}) AS BIGINT) AS most_after FROM ({TRIM_SQL}) GROUP BY trimmed")
def trim_telemetry(spark, sf_dir):
    return token_trim(spark, sf_dir).groupBy("trimmed").agg(F.count("*").alias("n"), F.max(text.word_count(F.col("trimmed_text"))).cast("long").alias("most_after"))


# --- Metadata, resume, batches, gates ----------------------------------------------------------------------------


@query("SELECT event_id, array_to_string(list_filter(['k', 'seed', 'v'], lambda x: NOT list_contains(json_keys(props), x)), ',') AS missing FROM events")
def metadata_keys(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.array_join(gates.keys_missing(F.col("props"), ("seed", "k", "v")), ",").alias("missing"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def resume_pending(spark, sf_dir):
    marks = table(spark, sf_dir, "labels").select(F.lit("sample").alias("kind"), F.col("doc_id").cast("string").alias("id"))
    return progress.pending(table(spark, sf_dir, "documents").select("doc_id"), marks, "sample", "doc_id")


@query("SELECT event_id, event_id // 8 AS batch, event_id % 8 AS slot FROM events")
def micro_batches(spark, sf_dir):
    return inference.micro_batches(table(spark, sf_dir, "events").select("event_id"), 8, "event_id")


@query("""
WITH g AS (SELECT r.range AS resolution, m.range * 0.5 AS gib, f.range = 1 AS fused FROM range(256, 1600, 64) r, range(2, 60) m, range(2) f)
SELECT resolution, CAST(gib AS DOUBLE) AS gib, fused, CAST(greatest(1, CASE WHEN resolution >= 1024 THEN CASE WHEN gib < 11 THEN 1 WHEN gib < 14 THEN 2 WHEN gib < 20 THEN 3 ELSE 4 END
  WHEN resolution >= 768 THEN CASE WHEN gib < 8 THEN 1 WHEN gib < 12 THEN 2 WHEN gib < 20 THEN 4 ELSE 6 END
  ELSE CASE WHEN gib < 6 THEN 1 WHEN gib < 8 THEN 2 WHEN gib < 12 THEN 4 ELSE 8 END END - CASE WHEN fused THEN 0 ELSE 1 END) AS INTEGER) AS cap FROM g""")
def batch_cap(spark, sf_dir):
    grid = spark.range(256, 1600, 64).select(F.col("id").alias("resolution"), F.explode(F.sequence(F.lit(2), F.lit(59))).alias("m")).select("resolution", (F.col("m") * F.lit(0.5)).cast("double").alias("gib"), F.explode(F.array(F.lit(False), F.lit(True))).alias("fused"))
    return grid.withColumn("cap", inference.batch_cap(F.col("resolution"), F.col("gib"), F.col("fused")))


@query("""
WITH s AS (SELECT format('s{:04d}-r{:04d}', doc_id // 100, doc_id % 100) AS id FROM labels), e AS (SELECT format('s{:04d}-r{:04d}', range // 100, range % 100) AS id FROM range(300)),
m AS (SELECT id FROM e WHERE id NOT IN (SELECT id FROM s)), x AS (SELECT DISTINCT id FROM s WHERE id NOT IN (SELECT id FROM e)), n AS (SELECT count(DISTINCT id) AS n FROM s),
f AS (SELECT (SELECT count(*) FROM m) AS nm, (SELECT count(*) FROM x) AS nx, (SELECT array_to_string(list_sort(list(id))[1:20], ', ') FROM m) AS ms, (SELECT array_to_string(list_sort(list(id))[1:20], ', ') FROM x) AS xs),
g AS (SELECT 'count' AS name, n = 300 AS passed, 'Found ' || n || ' samples, expected 300' AS details, CASE WHEN n = 300 THEN '' ELSE 'Count mismatch: ' || n || ' != 300' END AS failures FROM n
  UNION ALL SELECT 'coverage', nm + nx = 0, 'Expected 300 IDs, found ' || n, concat_ws('; ', CASE WHEN nm > 0 THEN 'Missing ' || nm || ' samples: ' || ms END, CASE WHEN nx > 0 THEN 'Extra ' || nx || ' samples: ' || xs END) FROM f, n)
SELECT * FROM g UNION ALL SELECT 'completion', bool_and(passed), CASE WHEN bool_and(passed) THEN 'All gates passed' ELSE 'Failed: ' || array_to_string(list_sort(list(name) FILTER (NOT passed)), ', ') END, '' FROM g""")
def gate_report(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").select(shards.sample_id(F.expr("doc_id div 100"), F.expr("doc_id % 100")).alias("id"))
    return gates.completed(gates.count_gate(rows, 300).unionByName(gates.coverage_gate(rows, 300, 100))).withColumn("failures", F.array_join("failures", "; "))


@query("""
WITH b AS (SELECT event_id, printf('%08d', event_id) || ': odd value' AS message FROM events WHERE value > 50 AND event_id % 2 = 1)
SELECT count(*) AS n, (SELECT array_to_string(list(message ORDER BY event_id), '; ') FROM (SELECT * FROM b ORDER BY event_id LIMIT 100)) AS failures FROM b""")
def capped_failures(spark, sf_dir):
    """LIM-2: the report lists the first hundred; the cap is the feature."""
    bad = (F.col("value") > 50) & (F.col("event_id") % 2 == 1)
    rows = table(spark, sf_dir, "events").select("event_id", F.when(bad, F.concat(F.format_string("%08d", "event_id"), F.lit(": odd value"))).alias("message"))
    return gates.first_failures(rows, "message", "event_id").withColumn("failures", F.array_join("failures", "; "))


@query("SELECT conv_id, turn, role FROM conversations QUALIFY row_number() OVER (ORDER BY conv_id, turn) <= 100")
def prefix_limit(spark, sf_dir):
    """LIM-1: a plan reads up to its target; the limit is the feature."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role").orderBy("conv_id", "turn").limit(100)


@query("SELECT page_id, strlen(html) AS n_bytes, sha256(html) AS digest, url FROM pages")
def tar_roundtrip(spark, sf_dir):
    """Pages as payload and JSON sidecar, packed in tar shards and read back."""
    folder = f"{shared_folder(spark)}/sieveworks/tar-{uuid.uuid4().hex}"
    folder = folder.removeprefix("file://") if folder.startswith("file:///") else folder
    pages = table(spark, sf_dir, "pages")
    rows = pages.select(F.expr("page_id div 100").alias("shard_id"), (F.col("page_id") % 100).alias("idx"), F.col("page_id").cast("string").alias("id"), F.col("html").cast("binary").alias("png"), F.to_json(F.struct("url")).alias("json"))
    tar.write(rows, folder).count()
    found = tar.samples(spark, folder)
    return found.select(F.col("id").cast("long").alias("page_id"), F.octet_length("png").cast("long").alias("n_bytes"), F.sha2("png", 256).alias("digest"), F.get_json_object("json", "$.url").alias("url"))


@query("""SELECT conv_id, turn, '{"id": "' || conv_id || '", "role": "' || role || '", "turn": ' || turn || '}' AS line FROM conversations""")
def json_lines(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").withColumn("id", F.col("conv_id").cast("string"))
    return rows.select("conv_id", "turn", text.json_line(["id", "role"], ["turn"], ["id", "role", "turn"]).alias("line"))


@query()
def records_digest(spark, sf_dir):
    return jsonl.digest(generate_prompts(spark, sf_dir))


@query("SELECT conv_id || '-' || turn AS id, CAST(16 AS BIGINT) AS width, CAST(16 AS BIGINT) AS height, 0 AS n_missing FROM conversations")
def image_inference(spark, sf_dir):
    """Images of all conversations by the stub model, with their checks."""
    rows = table(spark, sf_dir, "conversations").select(F.lit(0).alias("shard_id"), F.col("turn").alias("idx"), F.concat_ws("-", "conv_id", "turn").alias("id"), F.col("text").alias("positive_prompt"), F.lit("").alias("negative_prompt"), F.col("conv_id").alias("seed"))
    made = inference.generate(rows, {"batch_size": 4, "model_id": "stub", "num_inference_steps": 1, "guidance_scale": 7.0, "scheduler": "none", "resolution": 16})
    return made.select("id", png.width(F.col("png")).alias("width"), png.height(F.col("png")).alias("height"), F.size(gates.keys_missing(F.col("json"))).alias("n_missing"))


# --- Lints of components, lines, progress, archives and gates ----------------------------------------------------

GAPS_SQL = {"subject": "'s'", "eyes": "CASE WHEN p_size % 5 = 0 THEN '' ELSE 'blue' END", "hair_color": "CASE WHEN p_size % 7 <> 0 THEN p_brand END", "hair_style": "p_type", "expression": "CASE WHEN p_size % 11 = 0 THEN '' ELSE 'smile' END"}


@query("SELECT p_partkey, array_to_string(list_filter([" + ", ".join(f"CASE WHEN coalesce({v}, '') = '' THEN 'missing {k}' END" for k, v in GAPS_SQL.items()) + "], lambda m: m IS NOT NULL), '; ') AS violations FROM part")
def component_lint(spark, sf_dir):
    size = F.col("p_size")
    rows = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.lit("s").alias("subject"),
        F.when(size % 5 == 0, "").otherwise("blue").alias("eyes"),
        F.when(size % 7 != 0, F.col("p_brand")).alias("hair_color"),
        F.col("p_type").alias("hair_style"),
        F.when(size % 11 == 0, "").otherwise("smile").alias("expression"),
    )
    return rows.select("p_partkey", F.array_join(rules.component_lint(), "; ").alias("violations"))


def _folder(spark: SparkSession, name: str) -> str:
    folder = f"{shared_folder(spark)}/sieveworks/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    return folder.removeprefix("file://") if folder.startswith("file:///") else folder


JSONL_TARGET = 60


@query(f"""
SELECT line_no, conv_id || '-' || turn AS id, turn AS seed, CASE WHEN turn % 3 = 1 THEN NULL ELSE role END AS negative_prompt, CASE WHEN turn % 3 = 1 THEN 4 ELSE 5 END AS n_keys
FROM (SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS line_no FROM conversations) WHERE line_no < {JSONL_TARGET}""")
def jsonl_scan(spark, sf_dir):
    """SRC-3, LIM-1: lines in file order up to a target (the feature), blank lines skipped, damage behind the target unseen."""
    folder = _folder(spark, "lines")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat_ws("-", "conv_id", "turn").alias("id"), F.lit("p").alias("positive_prompt"), F.when(F.col("turn") % 3 != 1, F.col("role")).alias("negative_prompt"), F.lit(0).alias("shard_id"), F.col("turn").alias("seed"))
    line = F.to_json(F.struct(*jsonl.ORDER))
    lines = rows.orderBy("conv_id", "turn").select(F.explode(F.array(line, F.lit(""), F.lit("  "))).alias("value"))
    lines.write.text(f"{folder}/1")
    spark.createDataFrame([('{"id": damaged',)], "value string").write.text(f"{folder}/2")
    found = jsonl.read_records(spark, f"{folder}/*", JSONL_TARGET)
    return found.select("line_no", "id", "seed", "negative_prompt", F.size("keys").alias("n_keys"))


@query("SELECT doc_id, doc_id IN (SELECT doc_id FROM labels) AS done FROM documents")
def progress_resume(spark, sf_dir):
    """SRC-6, SNK-9, FLT-7: marks appended by two runs, with repeats, are loaded, and what is left is pending."""
    folder = _folder(spark, "progress")
    docs, marks = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    before = progress.load(spark, folder)
    first = progress.pending(marks.where("id % 2 = 0"), before, "sample")
    progress.append(first, "sample", folder)
    progress.append(marks, "sample", folder)
    progress.append(docs.select(F.col("doc_id").alias("id")), "shard", folder)  # marks of another kind count for nothing
    left = progress.pending(docs, progress.load(spark, folder), "sample", "doc_id").select("doc_id", F.lit(False).alias("done"))
    done = progress.load(spark, folder).where("kind = 'sample'").select(F.col("id").cast("long").alias("doc_id"), F.lit(True).alias("done"))
    return left.unionAll(done.join(docs, "doc_id", "left_semi"))


@query("SELECT DISTINCT page_id // 100 AS shard_id, (page_id // 100) % 2 = 0 AS written_now FROM pages")
def archives_present(spark, sf_dir):
    """SRC-7, FLT-9: archives that stand under their names are listed, and only the other shards are written."""
    folder = _folder(spark, "archives")
    pages = table(spark, sf_dir, "pages")
    rows = pages.select(F.expr("page_id div 100").alias("shard_id"), (F.col("page_id") % 100).alias("idx"), F.col("page_id").cast("string").alias("id"), F.col("html").cast("binary").alias("png"), F.lit("{}").alias("json"))
    tar.write(rows.where("shard_id % 2 = 1"), folder, "shard").count()
    before = tar.present(spark, folder, "shard").collect()  # a row an archive
    there = spark.createDataFrame(before, "shard_id long")
    tar.write(rows.join(there, "shard_id", "left_anti"), folder, "shard").count()
    return tar.present(spark, folder, "shard").join(there.withColumn("old", F.lit(True)), "shard_id", "left").select("shard_id", F.col("old").isNull().alias("written_now"))


IMAGE, SMALL = png.render("image", 1, 16), png.render("image", 1, 8)
SIDECAR = "{" + ", ".join(f'"{k}": 1' for k in gates.METADATA) + "}"
SAMPLES_SQL = """SELECT format('s{:04d}-r{:04d}', doc_id // 100, doc_id % 100) AS id,
  CASE WHEN doc_id % 50 = 3 THEN 'decode error: cut short' WHEN doc_id % 70 = 1 THEN 'size 8x8, expected 16x16' WHEN doc_id % 90 = 2 THEN 'missing PNG data' END AS image,
  CASE WHEN doc_id % 60 = 4 THEN 'missing metadata JSON' WHEN doc_id % 45 = 7 THEN 'missing fields guidance_scale, model_id, negative_prompt, num_inference_steps, resolution, scheduler, seed' END AS metadata FROM labels"""


def _samples(spark, sf_dir):
    d = F.col("doc_id")
    image = F.when(d % 50 == 3, F.lit(IMAGE[:40])).when(d % 70 == 1, F.lit(SMALL)).when(d % 90 != 2, F.lit(IMAGE))
    image = F.when((d % 90 == 2) & (d % 50 != 3) & (d % 70 != 1), F.lit(None).cast("binary")).otherwise(image)
    sidecar = F.when(d % 60 == 4, F.lit(None).cast("string")).when(d % 45 == 7, '{"prompt": 1}').otherwise(SIDECAR)
    return table(spark, sf_dir, "labels").select(shards.sample_id(F.expr("doc_id div 100"), F.expr("doc_id % 100")).alias("id"), image.alias("png"), sidecar.alias("json"))


def _gate_sql(name: str, column: str, what: str) -> str:
    return f"""SELECT '{name}' AS name, count({column}) = 0 AS passed, 'Checked ' || count(*) || ' {what}, ' || count({column}) || ' failures' AS details,
      coalesce((SELECT array_to_string(list(id || ': ' || {column} ORDER BY id), '; ') FROM (SELECT * FROM s WHERE {column} IS NOT NULL ORDER BY id LIMIT {gates.LISTED})), '') AS failures FROM s"""


GATES_SQL = {"image_gate": _gate_sql("image_integrity", "image", "images"), "metadata_gate": _gate_sql("metadata", "metadata", "metadata files")}


def _told(rows: DataFrame) -> DataFrame:
    return rows.withColumn("failures", F.array_join("failures", "; "))


@query(f"WITH s AS ({SAMPLES_SQL}) {GATES_SQL['image_gate']}")
def image_gate(spark, sf_dir):
    return _told(gates.image_gate(_samples(spark, sf_dir), 16))


@query(f"WITH s AS ({SAMPLES_SQL}) {GATES_SQL['metadata_gate']}")
def metadata_gate(spark, sf_dir):
    return _told(gates.metadata_gate(_samples(spark, sf_dir)))


@query(ORACLES["gate_report"].replace("WITH s AS", "WITH r AS").replace("FROM s", "FROM r").replace("id IN (SELECT id FROM r)", "id IN (SELECT id FROM r)").replace(
    "f AS (SELECT", f"s AS ({SAMPLES_SQL}), f AS (SELECT", 1).replace("SELECT * FROM g UNION ALL", "SELECT * FROM h UNION ALL").replace("END, '' FROM g", "END, '' FROM h").replace(
    "FROM f, n)", f"FROM f, n), h AS (SELECT * FROM g UNION ALL {GATES_SQL['image_gate']} UNION ALL {GATES_SQL['metadata_gate']})", 1))
def validation_report(spark, sf_dir):
    return _told(gates.validate(_samples(spark, sf_dir), 300, 100, 16))


@query("""
WITH g AS (SELECT name, passed, failures FROM (VALUES ('a', true, ''), ('b', false, 'x; y'), ('c', false, '')) AS t(name, passed, failures))
SELECT name, failures FROM g WHERE NOT passed AND failures <> ''""")
def failure_breakdown(spark, sf_dir):
    """AGG-15."""
    told = spark.createDataFrame([("a", True, []), ("b", False, ["x", "y"]), ("c", False, [])], "name string, passed boolean, failures array<string>")
    return gates.failure_breakdown(told).withColumn("failures", F.array_join("failures", "; "))


@query("""
WITH l AS (SELECT conv_id, turn, '{"id": "' || conv_id || '", "role": "' || role || '", "turn": ' || turn || '}' AS line FROM conversations),
b AS (SELECT conv_id // 100 AS b, count(*) AS n, sha256(string_agg(sha256(line), '' ORDER BY conv_id, turn)) AS d FROM l GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS n, sha256(string_agg(d, '' ORDER BY b)) AS digest FROM b""")
def ordered_digest(spark, sf_dir):
    """SNK-3: over the bytes of the lines in order, block by block."""
    lines = json_lines(spark, sf_dir).withColumn("block", F.expr("conv_id div 100"))
    return jsonl.ordered_digest(lines, "line", ["conv_id", "turn"], "block")


@query("""
WITH p AS (SELECT lang, count(*) AS done, (SELECT count(*) FROM documents) AS total FROM documents GROUP BY lang)
SELECT lang, done, total, round(100.0 * done / total, 1)::DOUBLE AS share FROM p""")
def progress_share(spark, sf_dir):
    """SNK-12, PRJ-14: shares of a total that is observed while the counts are written, without a job of its own."""
    rows, seen = telemetry.observed(table(spark, sf_dir, "documents").select("lang"), "rows")
    counts = written(rows.groupBy("lang").agg(F.count("*").alias("done")), "counts")
    return counts.withColumn("total", F.lit(seen.get["n"])).withColumn("share", telemetry.percentage(F.col("done"), F.col("total")))
