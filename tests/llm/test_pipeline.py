"""The pipeline's stages in order on hostile rows, and the registration."""

import __spark_entry__ as E
import corpus_pipeline as P
from cohortlens.llm.common import saved
from tests.llm.fixtures import EDGE, documents, prose
from tests.llm.test_models import toxic_rows


def test_registered():
    names = [n for n in E.queries() if n.startswith("op")]
    assert {int(n[2:].split("_")[0]) for n in names} == set(range(1, 14)) and "pipeline" in E.queries()


def test_stages(spark, tmp_path):
    rows, labels = toxic_rows(400)
    item = prose(800, 40)
    rows += [(i + 2000 if i else i, t) for i, t in EDGE] + [(3000, prose(1, 400)), (3001, prose(1, 400) + " more"),
                                                            (3002, f"{prose(31, 9)} {item} {prose(32, 9)}")]
    docs = documents(spark, rows)
    docs.drop(*[c for c in docs.columns if c not in P.COLUMNS]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, t) for i, t in labels.items()], "doc_id long, quality int, toxic int") \
        .write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    sf = str(tmp_path)
    cur, ids = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in P.STAGES[:-1]:
        cur = saved(stage(spark, cur, sf), name)
        assert cur.columns == list(P.COLUMNS)
        ids.append({r.doc_id for r in cur.collect()})
    toxic = {i for i, t in labels.items() if t}
    assert ids[0] == {i for i, _ in rows} - toxic
    assert ids[0] - ids[1] == {2007, 3001}
    assert ids[1] - ids[2] == {3002}
    assert ids[3] <= ids[2] and len(ids[3]) > 0.3 * len(ids[2])
    out = P.run(spark, sf).collect()
    assert {r.doc_id for r in out} == ids[3]
    assert sum(r.n_tokens for r in out) == max(r.start + r.n_tokens for r in out)
    empty = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for name, stage in P.STAGES:
        assert stage(spark, empty, sf).count() == 0


def test_rows_without_id_are_judged(spark, tmp_path):
    rows, labels = toxic_rows(400)
    item = prose(800, 40)
    dirty, held = prose(41, 30) + " moron", f"{prose(31, 9)} {item} {prose(32, 9)}"
    clean = [prose(900 + k, 30) for k in range(40)]
    docs = documents(spark, rows + [(None, t) for t in [dirty, held, *clean, None]]).select(*P.COLUMNS)
    spark.createDataFrame([(i, t) for i, t in labels.items()], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    def loose(df):
        return {r.text for r in df.filter("doc_id IS NULL").collect()}
    assert loose(P.toxic_out(spark, docs, str(tmp_path))) == {held, *clean, None}
    assert loose(P.benchmark_out(spark, docs, str(tmp_path))) == {dirty, *clean, None}
    assert 5 < len(loose(P.mixed(spark, docs, str(tmp_path))) & set(clean)) < 40
    # A copy without id goes, the document with an id stays.
    twice = documents(spark, [(7, clean[0]), (None, clean[0]), (None, clean[1])]).select(*P.COLUMNS)
    kept = P.near_copies_out(spark, twice, str(tmp_path)).collect()
    assert {(r.doc_id, r.text) for r in kept} == {(7, clean[0]), (None, clean[1])}
