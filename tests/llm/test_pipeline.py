"""run() against its stages done by brute force on the kept rows."""

import hashlib

import corpus_pipeline
import duckdb
from test_operators import components, lower

from tidewheel.llm import bpe, toxicity
from tidewheel.llm.common import table

SF = "/root/testdata/sf0.001"


def test_run(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    scores = {r.doc_id: r.predicted for r in toxicity.score_toxicity(table(spark, SF, "documents"), table(spark, SF, "labels")).collect()}
    docs = [d for d in docs if not scores[d[0]]]
    last = {}
    for i, t in docs:
        last[lower(t)] = max(i, last.get(lower(t), -1))
    docs = [d for d in docs if last[lower(d[1])] == d[0]]
    first = {i: c for i, _, c in components(docs)}
    docs = [d for d in docs if first[d[0]] == d[0]]
    items = [r[0] for r in duckdb.connect().execute(f"select text from '{SF}/benchmark.parquet'").fetchall()]
    docs = [d for d in docs if not any(item in d[1] for item in items)]
    own = bpe.BytePairCodec(bpe.load_rules(bpe.default_vocabulary()))
    want = {i: (len(own.encode(t)), hashlib.sha256(",".join(map(str, own.encode(t))).encode()).hexdigest()) for i, t in docs}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "toxicity" and len(corpus_pipeline.STAGES) == 5


SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, set string, component_id long, keep_id long, n long"
SAME = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
NEAR = SAME + " more"


def rows_of(spark, *rows):
    return spark.createDataFrame([(i, t, "en", "s", 1, "clash", -1, -2, -3) for i, t in rows], SCHEMA)


def left(df):
    assert df.columns == [part.split(" ")[0] for part in SCHEMA.split(", ")]
    assert all((r["set"], r.component_id, r.keep_id, r.n) == ("clash", -1, -2, -3) for r in df.collect())
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_stages_take_an_empty_table(spark):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, rows_of(spark), SF).count() == 0, name


def test_stages_on_nulls_ties_and_repeats(spark):
    stages = dict(corpus_pipeline.STAGES)
    odd = [(1, None), (2, ""), (3, " \t\n"), (None, "alone"), (4, "x" * 50_000)]
    passed = left(stages["toxicity"](spark, rows_of(spark, *odd, (4, "x" * 50_000)), SF))
    assert passed == sorted([*odd, (4, "x" * 50_000)], key=str)
    copies = [*odd, (9, "Same"), (5, "sAME"), (9, "same"), (None, "SAME"), (5, "other"), (None, "alone"), (None, "ALONE")]
    kept = left(stages["exact dedup"](spark, rows_of(spark, *copies), SF))
    assert [(i, (t or "").lower()) for i, t in kept] == [(i, (t or "").lower()) for i, t in sorted([(2, ""), (3, " \t\n"), (4, "x" * 50_000), (5, "other"), (9, "same"), (None, "alone")], key=str)]
    near = [*odd, (7, SAME), (6, NEAR), (8, NEAR), (8, "quite another text"), (10, SAME), (None, SAME)]
    kept = left(stages["n-gram Jaccard join"](spark, rows_of(spark, *near), SF))
    assert kept == sorted([*odd, (6, NEAR), (8, NEAR), (8, "quite another text"), (None, SAME)], key=str)
    item = duckdb.connect().execute(f"select text from '{SF}/benchmark.parquet' order by length(text) desc").fetchone()[0]
    leaks = [*odd, (7, item), (8, "clean words only here"), (8, f"so {item}"), (None, item)]
    assert left(stages["benchmark decontamination"](spark, rows_of(spark, *leaks), SF)) == sorted([*odd, (None, item)], key=str)
    done = stages["BPE encoding and decoding"](spark, rows_of(spark, *odd, (4, "y")), SF)
    assert sorted(((r.doc_id, r.n_tokens > 0) for r in done.collect()), key=str) == sorted([(1, False), (2, False), (3, True), (None, True), (4, True), (4, True)], key=str)


def test_stages_keep_the_columns_of_documents(spark):
    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
