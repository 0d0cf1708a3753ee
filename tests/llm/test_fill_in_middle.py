"""Fill-in-middle against a text-by-text version with regular expressions."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from corpuslake.llm import fill_in_middle as fim
from tests.llm.tables import awkward, awkward_rows, with_extra

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def expected(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    units = UNIT.findall(text)
    assert "".join(units) == text
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    if h4 % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def odd_texts():
    rng = random.Random(5)
    alphabet = ["a", "é", "日", "😀", " ", "\t", "\n", "\r", "\x0b", "\x0c", "\x1c", "\xa0", "\u2003", "<", "P", "S>", ">", "<S"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 30))) for _ in range(600)]
    return [*texts, "<P>", "a <S> b", "<M", "x<P", ">", " ", "\n\n a", "a ", "a" * 5000, " " * 5000]


def test_outputs_equal_a_text_by_text_version(spark, monkeypatch):
    rows = [*awkward_rows(), *((1000 + k, t, "en", "a", len(t)) for k, t in enumerate(odd_texts()))]
    frame = with_extra(awkward(spark, rows)).withColumn("form", F.lit("clash")).repartition(3)
    found = fim.transformed(frame)
    assert found.columns == [*frame.columns, "fim"]
    back = found.withColumn("back", fim.restored(F.col("fim.output"), F.col("fim.form")))
    got = back.select("doc_id", "text", "fim.*", "back").collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[2:7]) == expected(r.doc_id, r.text)
        assert r.back == (r.text or "")
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_blocks_do_not_matter(monkeypatch):
    import pyarrow as pa

    texts = [None, *odd_texts(), ""]
    draws = [[random.Random(k).randrange(1 << 32) for _ in texts] for k in range(4)]
    outcomes = []
    for size in (1, 64, 4 << 20):
        monkeypatch.setattr(fim, "BLOCK_BYTES", size)
        import numpy as np

        draws_np = [np.array(d) for d in draws]
        parts = [
            fim._transform(rows, [d[a:b] for d in draws_np], 50, 80)
            for a, b, rows in fim.Rows.of(pa.array(texts, pa.string())).blocks()
        ]
        outcomes.append(pa.concat_arrays(parts).to_pylist())
    assert outcomes[0] == outcomes[1] == outcomes[2]


def test_a_slice_of_a_batch_keeps_its_texts():
    import pyarrow as pa

    column = pa.array(["one two", None, "three", "four five six"]).slice(1, 3)
    assert fim.Rows.of(column).strings().to_pylist() == ["", "three", "four five six"]


def test_empty_table_and_shares(spark):
    assert fim.digests(awkward(spark).limit(0)).count() == 0
    every = fim.transformed(awkward(spark), share=100, spm_share=0).select("text", "fim.form").collect()
    assert {r.form for r in every if r.text} == {"psm"} and {r.form for r in every if not r.text} == {"plain"}
    none = fim.transformed(awkward(spark), share=0).select("fim.form", "fim.output", "text").collect()
    assert all(r.form == "plain" and r.output == (r.text or "") for r in none)
