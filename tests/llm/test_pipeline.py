"""The pipeline against the single operators' plain versions, stage by stage."""

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from corpuslake.llm import language_filters, mixing, pseudonyms
from tests.llm.tables import EXTRA, awkward, with_extra
from tests.llm.test_groups import plain_simhash, union
from tests.llm.test_mixing import check
from tests.oracle_check import compare, database

SF_DIR = "/root/testdata/sf0.001"


def test_queries_equal_sql(spark):
    from corpuslake.llm.queries import ORACLE, QUERIES

    con = database(SF_DIR)
    for name, sql in ORACLE.items():
        assert compare(QUERIES[name](spark, SF_DIR), con, sql) is None, name


def test_every_operator_has_its_query():
    names = entry.queries()
    for k in range(1, 11):
        assert any(name.startswith(f"op{k}_") for name in names)
    assert names["pipeline"] is corpus_pipeline.run


def test_stages_of_given_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert docs.columns == columns
        kept.append(docs)
    language, groups, private, mixed, encoded = kept

    rows = [tuple(r) for r in language.collect()]
    assert len(rows) == 200  # all documents are clean text in a known language
    marks = {r[0]: plain_simhash(r[1]) for r in rows}
    ids = sorted(marks)
    roots = union([(a, b) for a in ids for b in ids if a < b and (marks[a] ^ marks[b]).bit_count() <= 2], ids)
    single = {r.doc_id: r.text for r in groups.collect()}
    assert set(single) == set(roots.values())
    texts = {r.doc_id: r.text for r in private.collect()}
    assert texts == {i: pseudonyms.pseudonymise_text(t)[0] for i, t in single.items()}
    check([tuple(r) for r in private.collect()], private, mixing.BLOCK)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = sorted((r.doc_id, library.encode(r.text, add_special_tokens=False).ids) for r in mixed.collect())
    assert sorted((r.doc_id, list(r.ids)) for r in encoded.collect()) == wanted


def test_stages_of_awkward_and_empty_documents(spark):
    clash = with_extra(awkward(spark)).drop("lang_pred").cache()
    for docs in (clash, clash.limit(0)):
        frame = docs
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            frame = stage(spark, frame, SF_DIR)
            if k < 4:
                assert frame.columns == clash.columns
        n = frame.count()
        assert (n > 0) == (docs is clash)
    assert set(EXTRA) - {"lang_pred"} <= set(clash.columns)
    assert language_filters.known_language(clash, language_filters.fit(clash), 0.3).where("text is null").count() == 0
