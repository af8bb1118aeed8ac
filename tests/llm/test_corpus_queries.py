"""Registered corpus queries over whole small tables, against brute force or SQL."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from oracle import compare, connect  # noqa: E402

SF = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()


def rows(spark, name, *columns):
    found = QUERIES[name](spark, SF)
    return sorted((tuple(r[c] for c in columns) for r in found.collect()), key=repr), found


def as_sorted(expected):
    return sorted(expected, key=repr)


def test_all_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES


@pytest.mark.parametrize("name", ["op6_exact_dedup", "op10_url_filter", "op11_phrase_mining", "op12_hard_negatives"])
def test_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), SQL[name]) is None


def test_op1(spark, docs):
    got, _ = rows(spark, "op1_language_id", "doc_id", "held_out", "lang_pred", "score")
    lang = dict(duckdb.sql(f"select doc_id, lang from '{SF}/documents.parquet'").fetchall())
    assert [g[0] for g in got] == as_sorted(d for d, _ in docs)
    assert all(g[1] == brute.held_out(g[0]) and 0 <= g[3] <= 1 for g in got)
    unseen = [g for g in got if g[1]]
    assert sum(g[2] == lang[g[0]] for g in unseen) >= 0.97 * len(unseen)


def test_op2(spark, docs):
    got, _ = rows(
        spark, "op2_best_fit_packing", "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
    assert sorted(g[:5] for g in got) == sorted(brute.op2_pieces(docs))
    by_sequence: dict = {}
    for g in got:
        by_sequence.setdefault(g[5], []).append((g[6], g[3]))
    for members in by_sequence.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 2048
    least = -(-sum(g[3] for g in got) // 2048)
    assert len(by_sequence) <= 1.02 * least + 1


def test_op3(spark, docs):
    assert rows(spark, "op3_bpe_round_trip", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")[0] == as_sorted(
        brute.op3(docs)
    )


def test_op4(spark, docs):
    got, found = rows(
        spark, "op4_license_scan", "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"
    )
    assert got == as_sorted(brute.op4(docs))
    for r in found.collect():
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1


def test_op5(spark, docs):
    assert rows(spark, "op5_token_counts", "doc_id", "n_bytes", "n_tokens", "over_limit")[0] == as_sorted(
        brute.op5(docs)
    )


def test_op7(spark, docs):
    got, _ = rows(spark, "op7_secret_scan", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
    base = {d: rest for d, *rest in brute.op7(docs)}
    for doc_id, assign, access, hex_, digest, spans in got:
        assert [assign, access, hex_] == base[doc_id][:3]
        assert digest == brute.sha(base[doc_id][3])
        assert set(filter(None, base[doc_id][3].split(","))) <= set(spans.split(","))
    assert len(got) == len(docs)


def test_op8(spark, docs):
    assert rows(spark, "op8_simhash_near_dedup", "doc_id", "fingerprint", "component_id")[0] == as_sorted(
        brute.op8(docs)
    )


def test_op9(spark, docs):
    got, found = rows(
        spark, "op9_quality_rules", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed",
    )
    assert got == as_sorted(brute.op9(docs))
    kept = {r["doc_id"]: r["kept"] for r in found.collect()}
    assert not any(kept[g[0]] for g in got if g[-1])
    assert sum(kept.values()) > 0.5 * len(kept)
