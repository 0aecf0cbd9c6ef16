"""The registered queries and the pipeline."""

import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import pytest
from conftest import SMALL

import __spark_entry__ as entry
from ledgerloom.llm import decontaminate, exact_dedup, near_dedup, quality
from ledgerloom.llm.common import scratch_folder
from ledgerloom.llm.oracle import llm_oracles
from ledgerloom.llm.queries import llm_queries, table
from workload.compare import as_bag, oracle_connection


def test_one_query_for_each_operator():
    names = [name.split("_")[0] for name in llm_queries()]
    assert sorted(names) == sorted(["pipeline", *(f"op{n}" for n in range(1, 14))])
    assert set(llm_queries()) <= set(entry.queries()) and set(llm_oracles()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", llm_oracles())
def test_query_matches_its_sql(spark, key):
    mine = llm_queries()[key](spark, SMALL)
    theirs = oracle_connection(SMALL).sql(llm_oracles()[key])
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert as_bag(mine.columns, mine.collect()) == as_bag(theirs.columns, theirs.fetchall())


def test_pipeline_stages_follow_their_operators(spark):
    """Each stage keeps what its operator says of what the stage before it kept."""
    docs = table(spark, SMALL, "documents")
    ids = lambda df: {row.doc_id for row in df.select("doc_id").collect()}
    says = [
        lambda d: quality.quality_scores(d, table(spark, SMALL, "labels")).filter("kept"),
        lambda d: exact_dedup.exact_duplicates(d).filter("kept"),
        lambda d: near_dedup.near_duplicates(d).filter("kept"),
        lambda d: decontaminate.contamination(d, table(spark, SMALL, "benchmark")).filter("NOT contaminated"),
        lambda d: d,
    ]
    sizes = [docs.count()]
    for (name, stage), said in zip(corpus_pipeline.STAGES, says):
        want = ids(said(docs))
        path = scratch_folder(spark, "test")
        stage(spark, docs, SMALL).write.parquet(path)
        out = spark.read.parquet(path)
        assert ids(out) == want and out.count() == len(want), name
        if name != "encode":
            assert out.columns == docs.columns
        docs = out
        sizes.append(len(want))
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.5 * sizes[0]
    assert docs.filter("NOT round_trip").count() == 0
    assert ids(corpus_pipeline.run(spark, SMALL)) == ids(docs)


def test_nothing_else_imports_the_subpackage():
    root = Path(entry.__file__).parent
    others = [p for p in root.rglob("*.py") if "llm" not in p.parts and p.name not in ("__spark_entry__.py", "corpus_pipeline.py")]
    assert not [p for p in others if "ledgerloom.llm" in p.read_text() and ".git" not in p.parts]


def test_entry_without_the_subpackage(tmp_path):
    """With the subpackage and the pipeline gone the other queries are there."""
    root = Path(entry.__file__).parent
    for name in ("workload", "__spark_entry__.py"):
        (tmp_path / name).symlink_to(root / name)
    (tmp_path / "ledgerloom").mkdir()
    for part in (root / "ledgerloom").iterdir():
        if part.name != "llm":
            (tmp_path / "ledgerloom" / part.name).symlink_to(part)
    code = (
        "import importlib.util as u, sys; sys.path.insert(0, '.')\n"
        "s = u.spec_from_file_location('e', '__spark_entry__.py'); e = u.module_from_spec(s)\n"
        "source = open('__spark_entry__.py').read().replace('Path(__file__).resolve()', 'Path(__file__).absolute()')\n"
        "exec(compile(source, s.origin, 'exec'), e.__dict__)\n"
        "assert not any(q.startswith('op') for q in e.queries()) and len(e.queries()) > 50 and e.oracle_sql()"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_own_scratch_folder_only_where_none_is_named(spark):
    class Without:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            applicationId, master = "test", "local[4]"

    one, two = scratch_folder(Without, "a"), scratch_folder(Without, "a")
    assert one != two and one.rsplit("/", 1)[0] == two.rsplit("/", 1)[0]
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert not shared or scratch_folder(spark, "a").startswith(shared)

    class OnACluster(Without):
        class sparkContext:
            applicationId, master = "test", "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(OnACluster, "a")
