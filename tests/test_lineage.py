import pytest
from pyspark.sql import functions as F

from tidewright.operators.lineage import lineage, missing_children, reachable, terminal_hops
from tidewright.sources.pipelinexml import hops, job_entries


def step(*pairs):
    body = "".join(
        f"<hop><from>{a}</from><to>{b}</to><enabled>{e}</enabled></hop>" for a, b, e in pairs
    )
    return f"<transformation><info><name>t</name></info><order>{body}</order></transformation>"


def job(*entries):
    body = "".join(
        f"<entry><name>{n}</name>" + (f"<filename>{f.replace(chr(38), chr(38) + 'amp;')}</filename>" if f else "") + "</entry>"
        for n, f in entries
    )
    return f"<job><name>j</name><entries>{body}</entries></job>"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("pipelines")
    files = {
        "start.kjb": job(
            ("START", None), ("one", "${dir}/one.ktr"), ("sub", "${dir}/sub.kjb"),
            ("gone", "${dir}/gone.ktr"), ("deep", "${dir}/x/deep.ktr"),
            ("run_job_all_succeed", "${dir}/run_job_all_succeed.ktr"),
        ),
        "sub.kjb": job(("chain", "${dir}/chain.ktr"), ("again", "${dir}/start.kjb"), ("self", "${dir}/sub.kjb")),
        "other.kjb": job(("fan", "${dir}/fan.ktr")),
        "one.ktr": step(("a", "b", "Y")),
        "chain.ktr": step(("a", "b", "Y"), ("b", "c", "Y"), ("b", "d", "N")),
        "fan.ktr": step(("a", "b", "Y"), ("a", "c", "Y"), ("x", "c", "Y")),
        "loop.ktr": step(("a", "b", "Y"), ("b", "a", "Y")),
        "empty.ktr": step(),
        "run_job_all_succeed.ktr": step(("p", "q", "Y")),
    }
    for name, text in files.items():
        (d / name).write_text(text)
    return str(d)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_single_hop_and_entries(spark, folder):
    got = hops(spark, folder)
    assert rows(got.where("file = 'one.ktr'"), "from_table", "to_table", "enabled") == [("a", "b", True)]
    assert got.where("file = 'empty.ktr'").count() == 0
    assert ("start.kjb", "deep", "deep.ktr") not in rows(job_entries(spark, folder), "file", "entry_name", "child")


def test_terminal_hops(spark, folder):
    got = rows(terminal_hops(hops(spark, folder)), "file", "from_table", "to_table")
    assert [r for r in got if r[0] == "chain.ktr"] == [("chain.ktr", "b", "c"), ("chain.ktr", "b", "d")]
    assert [r for r in got if r[0] == "fan.ktr"] == [
        ("fan.ktr", "a", "b"), ("fan.ktr", "a", "c"), ("fan.ktr", "x", "c"),
    ]
    assert not [r for r in got if r[0] == "loop.ktr"]


def test_terminal_and_inner_hops_are_all_hops(spark, folder):
    every = hops(spark, folder)
    inner = every.join(
        every.select("file", F.col("from_table").alias("to_table")), ["file", "to_table"], "left_semi"
    )
    assert terminal_hops(every).count() + inner.count() == every.count()


def test_lineage_follows_nested_jobs_and_ends_cycles(spark, folder):
    got = lineage(spark, folder, "start.kjb")
    assert rows(got, "job_name", "file", "from_table", "to_table", "enabled") == [
        ("chain", "chain.ktr", "b", "c", True), ("chain", "chain.ktr", "b", "d", False),
        ("one", "one.ktr", "a", "b", True),
    ]
    assert lineage(spark, folder, "start.kjb", only_enabled=True).count() == 2
    assert rows(lineage(spark, folder, "start.kjb", max_depth=0), "file") == [("one.ktr",)]


def test_missing_children(spark, folder):
    assert rows(missing_children(spark, folder), "child") == [("gone.ktr",)]


def test_file_names_with_blanks_and_other_scripts(spark, tmp_path):
    (tmp_path / "go.kjb").write_text(job(("x", "${dir}/维度 表&1%20.ktr"), ("y", "${dir}/子 作业.kjb")))
    (tmp_path / "子 作业.kjb").write_text(job(("z", "${dir}/plain.ktr")))
    (tmp_path / "维度 表&1%20.ktr").write_text(step(("读", "写", "Y")))
    (tmp_path / "plain.ktr").write_text(step(("a", "b", "Y")))
    got = lineage(spark, str(tmp_path), "go.kjb")
    assert rows(got, "job_name", "from_table") == [("x", "读"), ("z", "a")]
    assert missing_children(spark, str(tmp_path)).count() == 0


def test_reachable_gives_first_depth(spark):
    edges = spark.createDataFrame(
        [("a", "b"), ("b", "c"), ("a", "c"), ("c", "a"), ("c", "d"), ("z", "y")],
        "parent string, child string",
    )
    root = spark.createDataFrame([("a",)], "node string")
    assert rows(reachable(edges, root), "node", "depth") == [("a", 0), ("b", 1), ("c", 1), ("d", 2)]
