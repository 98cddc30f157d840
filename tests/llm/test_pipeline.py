"""The pipeline's stages, each against a plain version on its own input."""

from __future__ import annotations

import collections

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import FOLDER, write_tables
from tests.llm.test_operators import BLANKS, components_of, lower, words
from viewloom.llm.queries import QUERIES
from viewloom.session import cut_lineage


def test_stages_on_their_own_input(spark, documents):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "line_dedup", "near_dedup", "decontamination", "source_mix"]
    good = cut_lineage(stages["quality"](spark, documents, FOLDER))
    scored = {r.doc_id: r.predicted for r in QUERIES["op9_line_quality"](spark, FOLDER).collect()}
    assert {r.doc_id for r in good.collect()} == {i for i, p in scored.items() if p}
    assert good.columns == documents.columns

    lined = cut_lineage(stages["line_dedup"](spark, good, FOLDER))
    before = {r.doc_id: r for r in good.collect()}
    seen = collections.Counter(k for r in before.values() for k in {lower(x).strip(BLANKS) for x in r.text.split("\n")} - {""})
    for r in lined.collect():
        kept = [x for x in before[r.doc_id].text.split("\n") if seen[lower(x).strip(BLANKS)] < 10]
        assert r.text == "\n".join(kept) and (r.n_chars == len(r.text) or r.text == before[r.doc_id].text)
    assert lined.columns == documents.columns and lined.count() == good.count()

    one = cut_lineage(stages["near_dedup"](spark, lined, FOLDER))
    classes = components_of([(r.doc_id, r.text) for r in lined.collect()])
    assert sorted(r.doc_id for r in one.collect()) == sorted(set(classes.values()))

    clean = cut_lineage(stages["decontamination"](spark, one, FOLDER))
    windows = {tuple(w[i : i + 13]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect() for w in [words(r.text)] for i in range(len(w) - 12)}
    for r in one.collect():
        w, hit = words(r.text), set()
        for i in range(len(w) - 12):
            if tuple(w[i : i + 13]) in windows:
                hit.update(range(i, i + 13))
        assert (clean.where(f"doc_id = {r.doc_id}").count() == 0) == (bool(hit) and 20 * len(hit) >= len(w)) if hit else True
    assert clean.columns == documents.columns

    mixed = stages["source_mix"](spark, clean, FOLDER)
    assert mixed.columns == [*documents.columns, "copy"]
    assert mixed.count() == mixed.select("doc_id", "copy").distinct().count()


def test_a_group_of_copies_keeps_one_whole_text(spark, documents):
    whole = "the first line of a copy\nits second line\n\nand its third"
    near = "one line of near copies that is long\nand another one that is long"
    rows = [(100 + i, whole) for i in range(20)] + [(200 + i, f"{near}\nown {i}") for i in range(12)]
    rows += [(i, f"all rights reserved\nsomething longer that only document {i} has") for i in range(15)] + [(300, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("a"), "n_chars": F.length("text").cast("long")})
    stages = dict(corpus_pipeline.STAGES)
    lined = cut_lineage(stages["line_dedup"](spark, df.select(*documents.columns).repartition(4), FOLDER))
    got = {r.doc_id: r.text for r in lined.collect()}
    assert [i for i, t in got.items() if t == whole] == [100] and all((got[i] or "").strip() == "" for i in range(101, 120))
    assert got[200] == f"{near}\nown 0" and got[211] == "own 11" and got[300] is None
    assert all(got[i] == f"something longer that only document {i} has" for i in range(15))
    one = stages["near_dedup"](spark, lined, FOLDER).collect()
    assert [r.doc_id for r in one if r.text == whole] == [100]


def test_groups_that_share_lines_keep_a_whole_text_each(spark, documents):
    licence = "licensed under the same terms as everything else"
    one = f"{licence}\nthe only line of the first group of copies"
    two = f"{licence}\nthe only line of the second group of copies\nand one more"
    three = "the only line of the first group of copies\nthe only line of the second group of copies\nand one more"
    rows = [(100 + i, one) for i in range(12)] + [(200 + i, two) for i in range(12)] + [(300 + i, three) for i in range(2)]
    # Near copies: an edited line each, which is no line of others.
    rows += [(400 + i, f"{licence}\na line of all near copies that is long\nedited {i} times") for i in range(15)]
    rows += [(i, f"{licence}\nthis long text is of document {i} only, so that its licence is less than half of it") for i in range(30)]
    rows += [(500, f"{licence}\nand one more")]  # a copy without a group
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("a"), "n_chars": F.length("text").cast("long")})
    lined = dict(corpus_pipeline.STAGES)["line_dedup"](spark, df.select(*documents.columns).repartition(5), FOLDER)
    got = {r.doc_id: r.text for r in lined.collect()}
    assert got[100] == one and got[200] == two and got[300] == three
    assert {got[i] for i in (*range(101, 112), *range(201, 212), 301, 500)} == {""}
    assert got[400] == f"{licence}\na line of all near copies that is long\nedited 0 times" and got[401] == "edited 1 times"
    assert all(got[i] == f"this long text is of document {i} only, so that its licence is less than half of it" for i in range(30))


def test_other_columns_pass_all_stages(spark, clashing, documents, tmp_path):
    """Columns with the names of results and helpers stay with their documents; only ``copy`` is the mix's own."""
    names = [c for c in clashing.columns if c not in documents.columns]
    rows = documents.select("*", *[F.concat(F.lit(f"{name} "), "doc_id").alias(name) for name in names])
    both = rows.unionByName(clashing.select(*rows.columns))
    folder = write_tables(spark, str(tmp_path), both)
    got = corpus_pipeline.run(spark, folder)
    assert set(got.columns) == {*rows.columns, "copy"}
    plain = [r for r in got.collect() if r.doc_id in {d.doc_id for d in documents.select("doc_id").collect()} and not str(r.size).startswith("own")]
    assert len(plain) > 50 and all(r[name] == f"{name} {r.doc_id}" for r in plain for name in names if name != "copy")


def test_run_on_edge_cases_and_nothing(spark, edges, tmp_path):
    folder = write_tables(spark, str(tmp_path / "edges"), edges.select("doc_id", "text", "lang", "source", "n_chars"))
    assert set(corpus_pipeline.run(spark, folder).columns) == {"doc_id", "text", "lang", "source", "n_chars", "copy"}
    empty = write_tables(spark, str(tmp_path / "empty"), edges.select("doc_id", "text", "lang", "source", "n_chars").limit(0))
    assert corpus_pipeline.run(spark, empty).count() == 0
