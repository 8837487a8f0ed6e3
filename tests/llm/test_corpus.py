import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.brute import water_levels
from pyspark.sql import functions as F

from tidewright.llm import mixing, quality, sharding, urlfilter

URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "https://example.com", "https://example.com/en/",
    "https://a.example.com/en/1", "https://www.example.com/en/1", "https://m.www.example.com/en", "http://x.net/es/1",
    "http://net/fr/", "http://notnet/fr/", "http://x.net/de/?casino", "http://casino-win.example.net/de/1",
    "http://casinos.example.net/de/1", "http://free-bets.example.net/", "http://freebets.example.net/",
    "http://free.example.net/free/free", "http://a.org/porn", "http://a.org/x://y", "ftp://É.org/XXX", "http://a.net\n/es/\n",
    "casino.example.net/porn", "casino://a.org/", "http://a.org/?ref=x&page=2", "http://a.org/?q=free#bonus", "a?x#CASINO",
    "http://a.org/#poker", "http://a.org/" + "p/" * 60_000 + "?poker=free",
]


def pages(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")


def test_urls_equal_the_sql(spark):
    table = pages(spark, URLS * 2)
    got = urlfilter.judge_urls(table).select("page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits")
    con = duckdb.connect()
    con.register("pages", table.toPandas())
    want = con.execute(urlfilter.judge_sql() + " ORDER BY page_id").fetchall()
    assert [tuple(r) for r in got.orderBy("page_id").collect()] == want


def test_url_verdicts(spark):
    table = pages(spark, URLS).withColumn("host", F.lit("clash")).withColumn("verdict", F.lit(1))
    got = {r.url: (r.rule, r.verdict) for r in urlfilter.judge_urls(table).collect()}
    assert got["https://m.www.example.com/en"] == ("com/", "allow")
    assert got["https://www.example.com/en/1"] == ("www.example.com/en/", "allow")
    assert got["https://a.example.com/en/1"] == ("example.com/en/", "block")
    assert got["http://net/fr/"] == ("net/fr/", "block")
    assert got["http://casino-win.example.net/de/1"] == (None, "block")
    assert got["http://casinos.example.net/de/1"] == (None, "allow")
    assert got["http://free-bets.example.net/"] == (None, "block")
    assert got["http://free.example.net/free/free"] == (None, "allow")
    assert got[None] == got["no scheme"] == got["http://a.org/?ref=x&page=2"] == got["casino://a.org/"] == (None, "allow")
    for bad in ("http://x.net/de/?casino", "casino.example.net/porn", "http://a.org/?q=free#bonus", "a?x#CASINO", URLS[-1]):
        assert got[bad] == (None, "block")
    assert got["http://a.org/#poker"] == (None, "allow")
    assert urlfilter.judge_urls(pages(spark, URLS).limit(0)).collect() == []


def test_a_vocabulary_from_a_file(spark, tmp_path):
    (tmp_path / "terms.txt").write_text("# terms\nBad 2\n\nmeh 1\nhm  1\n")
    strict, soft = urlfilter.read_vocabulary(spark, str(tmp_path / "terms.txt"))
    assert (strict, soft) == (["bad"], ["hm", "meh"])
    table = pages(spark, ["http://a/bad", "http://a/meh", "http://a/meh?hm"])
    assert [r.verdict for r in urlfilter.judge_urls(table, (), strict, soft).orderBy("page_id").collect()] == ["block", "allow", "block"]


@settings(max_examples=60, deadline=None)
@given(n=st.integers(1, 3000), seed=st.integers(0, 2**40))
def test_the_permutation_is_one_and_can_be_undone(n, seed):
    placed = sharding.permute(np.arange(n), n, seed)
    assert sorted(placed.tolist()) == list(range(n))
    assert (sharding.permute(placed, n, seed, inverse=True) == np.arange(n)).all()


def test_shards(docs_of, odd_rows):
    rows = [*odd_rows, *odd_rows[:3], (None, "x")]
    got = sharding.shard_rows(docs_of(rows), shards=8).collect()
    again = sharding.shard_rows(docs_of(rows[::-1]), shards=8).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert len(got) == len(rows)
    slots = {s: sorted(r.slot for r in got if r.shard == s) for s in range(8)}
    assert all(x == list(range(len(x))) for x in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert sharding.shard_rows(docs_of(rows).limit(0), shards=8).collect() == []


def test_shards_are_the_permuted_places_of_the_sorted_rows(docs_of, odd_rows):
    import zlib

    rows = [*odd_rows, (None, "x"), (None, None)]
    got = sharding.shard_rows(docs_of(rows).selectExpr("*", "1 as row", "2 as shard", "3 as size"), shards=3, seed=9).collect()
    keyed = [(i is not None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t in rows]
    places = sharding.permute(np.arange(len(rows)), len(rows), 9)
    want = {k: (n, p % 3, p // 3) for n, (k, p) in enumerate(zip(sorted(keyed), places.tolist(), strict=True))}
    assert {(r.doc_id is not None, r.doc_id or 0, r.text_crc32, r["size"]): (r.row, r.shard, r.slot) for r in got} == want


@pytest.mark.parametrize("group", [[(10, 0.5), (7, 0.25), (3, 0.9), (40, 0.1), (7, 0.6)], [(5, 0.5)], [(4, 0.5), (4, 0.5)]])
def test_folding_a_group_equals_a_plain_fold(spark, group):
    """Units meet in order; the random numbers are asked of Spark, the rest is done again in Python."""
    seeds = 300
    units = [((k + 1, 100 + k), float(s), p) for k, (s, p) in enumerate(group)]
    table = spark.range(seeds).select(
        F.col("id").cast("int").alias("seed"),
        F.array(*[F.struct(F.struct(F.lit(k[0]).cast("long").alias("a"), F.lit(k[1]).cast("long").alias("b")).alias("k"),
                           F.lit(s).alias("s"), F.lit(p).alias("p")) for k, s, p in units]).alias("units"),
    )
    chances = {
        (r.seed, r.i, r.j): r.c
        for r in table.select("seed", F.posexplode("units").alias("i", "u"), "units")
        .select("seed", "i", "u", F.posexplode("units").alias("j", "v"))
        .select("seed", "i", "j", mixing._chance(F.col("seed"), 2, F.col("u.k"), F.col("v.k")).alias("c"))
        .collect()
    }
    got = table.select("seed", mixing._fold(F.col("units"), F.col("seed"), 2).alias("f")).collect()
    sums = np.zeros(len(units))
    for r in got:
        held, p, ends = 0, units[0][2], {}
        for j in range(1, len(units)):
            (_, s, _), (_, t, q) = units[held], units[j]
            up, down = min((1 - p) * s, q * t), min(p * s, (1 - q) * t)
            moved = up if chances[r.seed, held, j] * (up + down) < down else -down
            x, y = (0.0 if v < 1e-9 else 1.0 if v > 1 - 1e-9 else v for v in (p + moved / s, q - moved / t))
            if x in (0.0, 1.0):
                ends[held], held, p = x, j, y
            else:
                ends[j], p = y, x
        assert {u.k.a - 1: u.p for u in r.f.done} == pytest.approx(ends)
        assert (r.f.held.k.a - 1, r.f.held.p) == (held, pytest.approx(p))
        assert sum(units[k][1] * v for k, v in {**ends, held: p}.items()) == pytest.approx(sum(s * p for _, s, p in units))
        sums += [{**ends, held: p}[k] for k in range(len(units))]
    expected = np.array([p for _, _, p in units])
    assert (np.abs(sums / seeds - expected) < 4 * np.sqrt(expected * (1 - expected) / seeds) + 1e-9).all()


@pytest.mark.parametrize("weights", [(1.0, 2.0, 3.0), (1.0, 50.0)])
def test_targets_equal_sharing_round_after_round(spark, weights):
    sizes = {"a": 10, "b": 0, "": 500, "é": 70, "Z": 3000, None: 20, "b2": 8}
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(table, weights).collect()}
    want = water_levels(sizes, weights, 3.0)
    assert got == pytest.approx(want)
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_mix(docs_of):
    rng = np.random.default_rng(6)
    rows = [(i, "w " * int(rng.integers(0, 90)), f"s{i % 3}") for i in range(900)]
    rows += [(1000, None, "s0"), (1001, "", None), (1002, "one two", None), (1002, "one two", None), (None, "a b c", "s1")]
    docs = docs_of(rows)
    got = mixing.mix(docs).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(5)).collect()))
    assert sum(r.repeats for r in got) == len(rows)
    assert all(0 <= r["copies"] <= 3 and (r.size or not r["copies"]) for r in got)
    for source in ("s0", "s1", "s2", None):
        mine = [r for r in got if r.source == source]
        taken = sum(r.size * r["copies"] * r.repeats for r in mine)
        assert abs(taken - mine[0].target) <= max(r.size * r.repeats for r in mine) / 2
    repeated = mixing.repeated(docs, mixing.mix(docs))
    assert repeated.columns == docs.columns
    assert repeated.count() == sum(r["copies"] * r.repeats for r in got)
    assert mixing.mix(docs.limit(0)).collect() == []


def labelled_corpus(docs_of, spark):
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(600):
        text = " ".join(rng.choice(words, 60)) + "."
        bad = i % 5 == 0
        rows.append((i, text.replace(" ", "*** ") if bad else text))
        labels.append((i, int(not bad), 0))
    return docs_of([*rows, (-1, None), (-2, ""), (-3, "\n")]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality(spark, docs_of):
    docs, labels = labelled_corpus(docs_of, spark)
    model = quality.learn(docs, labels)
    clash = docs.withColumn("score", F.lit("old")).withColumn("log_words", F.lit("kept"))
    got = quality.scored(clash, model).withColumn("out", quality.held_out(F.col("doc_id"))).collect()
    assert len(got) == 603 and {r.log_words for r in got} == {"kept"}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert all(r.predicted == truth[r.doc_id] for r in got if r.out and r.doc_id in truth)
    assert all(0 <= r.score <= 1 for r in got)
    assert quality.scored(docs.limit(0), model).collect() == []
    good = quality.accepted(clash, model)
    assert sorted(r.doc_id for r in good.collect()) == sorted(r.doc_id for r in got if r.predicted)
    assert quality.accepted(docs.limit(0), model).collect() == []


def plain_statistics(text):
    """The statistics of a text without Spark."""
    import math

    import regex

    text = text or ""
    words = [w for w in regex.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in regex.split(r"[ \t\n\x0b\f\r]*\n[ \t\n\x0b\f\r]*", text) if x]
    blank = r"[ \t\n\x0b\f\r]"

    def share(part, of):
        return part / of if of else 0.0

    def count(pattern):
        return len(regex.findall(pattern, text))

    return {
        "log_words": math.log1p(len(words)), "word_length": share(len(text), len(words)),
        "upper_share": share(count(r"\p{Lu}"), len(text)), "digit_share": share(count("[0-9]"), len(text)),
        "symbol_share": share(count(r"[#$%&*|<>{}\[\]=_~^\\@/+]"), len(words)),
        "odd_word_share": share(count(rf"(?:^|{blank})[^\p{{L}}\p{{N}} \t\n\x0b\f\r]+(?={blank}|$)"), len(words)),
        "stop_share": share(count(rf"[.?](?:{blank}|$)"), len(words)), "comma_share": share(count(","), len(words)),
        "distinct_share": share(len(set(words)), len(words)), "line_words": share(len(words), len(lines)),
        "distinct_lines": share(len(set(lines)), len(lines)), "exclaim_share": share(count("!"), len(words)),
    }


def test_scores_are_those_of_the_rules(spark, docs_of, odd_rows):
    import math

    docs, labels = labelled_corpus(docs_of, spark)
    model = quality.learn(docs, labels)
    assert model.rules
    rows = [*odd_rows, (501, "One, two! 3 $$ *** ###\nline two.\nline two.\n"), (502, "A B C ?"), (503, "*** ***")]
    for r in quality.scored(docs_of(rows).unionByName(docs), model).collect():
        known = plain_statistics(r.text)
        total = model.constant
        for rule, weight in zip(model.rules, model.weights, strict=True):
            total += weight * all((known[n] <= v) if at_most else (known[n] > v) for n, at_most, v in rule)
        assert r.score == pytest.approx(1 / (1 + math.exp(-total))), r.doc_id


def test_a_sample_smaller_than_the_labels(spark, docs_of):
    docs, labels = labelled_corpus(docs_of, spark)
    small = quality.learn(docs, labels, sample=60)
    again = quality.learn(docs.repartition(7), labels.repartition(5), sample=60)
    assert small == again and small.rules


def test_no_filter_on_the_prediction_reaches_the_scan(spark, docs_of):
    docs, labels = labelled_corpus(docs_of, spark)
    plan = quality.accepted(docs, quality.learn(docs, labels)).select("doc_id", "text")
    lines = [x.strip(" +-:") for x in plan._jdf.queryExecution().optimizedPlan().toString().splitlines()]
    assert [x.split()[0] for x in lines if x.startswith(("Filter", "Generate"))] == ["Filter", "Generate"]


def test_quality_with_one_label_or_none(spark, docs_of):
    docs, labels = labelled_corpus(docs_of, spark)
    for some, share in ((labels.limit(0), 0.5), (labels.where("quality = 1"), 1.0)):
        scores = {r.score for r in quality.scored(docs, quality.learn(docs, some)).collect()}
        assert len(scores) == 1 and scores.pop() == pytest.approx(share, abs=0.01)


def test_tree_paths():
    text = """RandomForest
  Tree 0 (weight 1.0):
    If (feature 0 <= 0.5)
     If (feature 0 <= 0.25)
      Predict: 0.0
     Else (feature 0 > 0.25)
      Predict: 1.0
    Else (feature 0 > 0.5)
     Predict: 1.0
"""
    name = quality.FEATURES[0]
    assert set(quality.tree_rules(text)) == {
        ((name, True, 0.5),),
        ((name, True, 0.25),),
        ((name, False, 0.25), (name, True, 0.5)),
        ((name, False, 0.5),),
    }


def test_pipeline_keeps_clean_documents_and_leaves_one_of_each_group(spark, docs_of, tmp_path):
    import corpus_pipeline as pipeline

    docs, labels = labelled_corpus(docs_of, spark)
    twins = docs.where("doc_id >= 0").withColumn("doc_id", F.col("doc_id") + 1000)
    again = docs.where("doc_id < 3 AND doc_id >= 0").withColumn("text", F.concat("text", F.lit(" more")))
    nameless = docs.where("doc_id in (1, 2, 7)").withColumn("doc_id", F.lit(None).cast("long"))
    docs.unionByName(twins).unionByName(nameless).unionByName(again).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    table = spark.read.parquet(str(tmp_path / "documents.parquet"))
    good = pipeline.quality_stage(spark, table, str(tmp_path))
    assert {r.doc_id % 1000 for r in good.where("doc_id >= 0").collect()} == {i for i in range(600) if i % 5}
    single = pipeline.exact_stage(spark, good, str(tmp_path))
    # Every text once, by its smallest id; repeated ids keep their other texts, null ids theirs if no other has it.
    assert single.where("doc_id >= 1000").count() == 0 and single.where("doc_id >= 0 AND NOT text LIKE '% more'").count() == 480
    assert single.where("text LIKE '% more'").count() == 2 and single.where("doc_id IS NULL").count() == 0
    assert single.columns == list(pipeline.DOCUMENT)
    near = pipeline.near_stage(spark, single, str(tmp_path))
    assert near.where("doc_id >= 0").count() == 480
    assert pipeline.near_stage(spark, single.withColumn("doc_id", F.lit(None).cast("long")), str(tmp_path)).count() == near.count()
    for stage in (pipeline.exact_stage, pipeline.near_stage, pipeline.mix_stage, pipeline.encode_stage):
        assert stage(spark, single.limit(0).withColumn("_key", F.lit("clash")), str(tmp_path)).collect() == []
    out = pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0
