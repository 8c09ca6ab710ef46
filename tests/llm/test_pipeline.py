import __spark_entry__ as E
import corpus_pipeline
from cosecha.llm.common import table
from cosecha.llm.decontam import decontaminate
from cosecha.llm.simhash import near_duplicates
from cosecha.llm.toxicity import fit
from test_decontam import brute as hits
from test_repeats import brute as repeats
from test_simhash import brute as classes


def test_every_stage_takes_effect(spark, sf0001):
    docs = table(spark, sf0001, "documents")
    names = docs.columns
    text = lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf0001)
        if name != "packing":
            assert docs.columns == names
            path = f"{spark.conf.get('spark.checkpoint.dir')}/stage-{name}"
            docs.write.mode("overwrite").parquet(path)
            docs = spark.read.parquet(path)
            kept[name] = text(docs)
    all_rows = text(table(spark, sf0001, "documents"))
    model = fit(table(spark, sf0001, "documents"), table(spark, sf0001, "labels"))
    toxic = {r.doc_id for r in model.score(table(spark, sf0001, "documents")).where("predicted = 1").collect()}
    assert sorted(kept["toxicity"]) == sorted(r for r in all_rows if r[0] not in toxic)
    stay = {d for d, _, c in classes(kept["toxicity"]) if d == c}
    assert sorted(kept["near_duplicates"]) == sorted(r for r in kept["toxicity"] if r[0] in stay)
    left = {d: n - g for d, n, g, _, _ in repeats(kept["near_duplicates"])}
    got = {d: len(t.encode()) for d, t in kept["repeats"]}
    assert sorted(got) == sorted(left) and all(left[d] - 6 * 4 * 9 <= got[d] <= left[d] for d in got)
    bench = [(r.item_id, r.text) for r in table(spark, sf0001, "benchmark").collect()]
    bad = {d for d, *_, c in hits(kept["repeats"], bench) if c}
    assert sorted(kept["decontamination"]) == sorted(r for r in kept["repeats"] if r[0] not in bad)
    assert {r.doc_id for r in docs.collect()} == {d for d, _ in kept["decontamination"]}


CASES = [(1, None, "x"), (1, None, "x"), (2, "", None), (None, "no id at all here", "n"), (3, "one and the same text", "a"),
         (3, "one and the same text", "b"), (4, "one and the same text", "c"), (5, "word " * 60_000, "long"),
         (2 ** 53 + 1, "a text of its own, seen nowhere else", "z")]


def test_stages_keep_clashing_columns_and_defined_cases(spark, sf0001):
    columns = ["doc_id", "text", "score", "predicted", "held_out", "key", "fp", "segment", "n_chars"]
    ddl = "doc_id long, text string, score string, predicted string, held_out string, key string, fp string, " \
          "segment string, n_chars long"
    docs = spark.createDataFrame([(i, t, s, "p", None, "k", "f", "g", None if t is None else len(t)) for i, t, s in CASES], ddl)
    key = lambda r: tuple((x is None, x) for x in r)
    rows = lambda df: sorted(map(tuple, df.collect()), key=key)
    given = rows(docs)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out, again = stage(spark, docs, sf0001), stage(spark, docs.repartition(3), sf0001)
        assert out.columns == columns and rows(out) == rows(again), name
        assert stage(spark, docs.limit(0), sf0001).count() == 0
        if name in ("toxicity", "decontamination"):
            assert rows(out) == given, name
        if name == "near_duplicates":
            kept = {(r.doc_id, r.text, r.score) for r in out.collect()}
            # texts without words are one component, equal texts another
            assert len([k for k in kept if not k[1]]) == 1 and len([k for k in kept if k[1] == CASES[4][1]]) == 1
            assert (3, CASES[4][1]) in {k[:2] for k in kept} and (None, "no id at all here", "n") in kept
        if name == "repeats":
            assert len(rows(out)) == len(given) and {r.score for r in out.collect()} == {r[2] for r in given}
            assert all(r.n_chars == len(r.text) for r in out.collect() if r.text is not None)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf0001).collect()
    assert {r.doc_id for r in pieces} == {c[0] for c in CASES}
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), sf0001).count() == 0


def test_queries_are_registered():
    names = [q for q in E.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14)) and "pipeline" in E.queries()


def test_queries_with_sql_equal_it(spark, sf0001):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf0001}/{t}.parquet')")
    for name in ("op2_chat", "op5_decontaminate"):
        df = E.queries()[name](spark, sf0001)
        cur = con.execute(E.oracle_sql()[name])
        cols = [d[0] for d in cur.description]
        assert sorted(map(str, (tuple(r[c] for c in cols) for r in df.collect()))) == sorted(map(str, cur.fetchall()))


def test_operators_agree_on_an_empty_table(spark, sf0001):
    none = table(spark, sf0001, "documents").limit(0)
    bench = table(spark, sf0001, "benchmark")
    assert near_duplicates(none).count() == 0 and decontaminate(none, bench).count() == 0
