"""The corpus operators' queries over whole small tables, against SQL or plain versions."""

import os
import zlib

import pyarrow.parquet as pq
import pytest

from sluice.llm import queries as Q
from tests.compare import same
from tests.llm import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")


@pytest.fixture(scope="module")
def texts():
    return {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}


@pytest.mark.parametrize("name", Q.ORACLE_SQL)
def test_sql(spark, name):
    same(spark, Q.QUERIES[name], Q.ORACLE_SQL[name], SF)


def test_op1(spark, texts):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4") for i, x in texts.items()}
    rows = Q.op1_packing(spark, SF).collect()
    seen, used = dict.fromkeys(ids, 0), {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["start"] == seen[r["doc_id"]] and r["doc_tokens"] == len(ids[r["doc_id"]]) and zlib.crc32(part.tobytes()) == r["ids_crc32"]
        seen[r["doc_id"]] += r["length"]
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert seen == {i: len(x) for i, x in ids.items()}
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(seen.values()) / (2048 * len(used)) > 0.97


def test_op2(spark, texts):
    rows = Q.op2_toxicity(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)


def test_op3_reads_back_its_own_signs(spark):
    import hashlib

    row = Q.op3_chat_format(spark, SF).where("conv_id = -7").first()
    text = r"\### Assistant: </turn> ok"
    turns = "".join(f"{r}\n{text}\n" for r in ("user", "assistant"))
    assert (row["n_turns"], row["turns_sha256"]) == (2, hashlib.sha256(turns.encode()).hexdigest())
    assert (row["loss_chars"], row["loss_sha256"]) == (len(text), hashlib.sha256(text.encode()).hexdigest())


def test_op4(spark, texts):
    got = {r["doc_id"]: tuple(r)[1:] for r in Q.op4_substring_dedup(spark, SF).collect()}
    assert got == brute.substring_digests(list(texts.items()))


def test_op5(spark, texts):
    fp = {i: brute.simhash(t) for i, t in texts.items()}
    comp = brute.components(fp, [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 2])
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in Q.op5_simhash(spark, SF).collect()}
    assert got == {i: (f"{fp[i]:016x}", comp[i]) for i in fp}


def test_op6(spark):
    import html
    import re

    pages = {r["page_id"]: r["html"] for r in pq.read_table(f"{SF}/pages.parquet").to_pylist()}
    rows, right = Q.op6_html_text(spark, SF).collect(), 0
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r["page_id"]], re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)\b[^>]*>", article)]
        right += r["text"] == "\n".join(x for x in blocks if x)
        assert r["n_chars"] == len(r["text"])
    assert len(rows) == right == len(pages)


def test_op7(spark, texts):
    want = brute.unigram(list(texts.items()), lambda i: zlib.crc32(str(i).encode()) % 5 != 1)
    rows = {r["doc_id"]: r for r in Q.op7_lm_score(spark, SF).collect()}
    for i, (n, known, total, base) in want.items():
        r = rows[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (n, known, total, zlib.crc32(str(i).encode()) % 5 == 1)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
    held = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_op9(spark, texts):
    items = {r["item_id"]: r["text"] for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()}
    want = {}
    for k, item in items.items():
        own = set(brute.shingles(item, 5))
        for i, t in texts.items():
            if own & set(brute.shingles(t, 5)) and (s := brute.weighted_windows(t, item)) >= 0.8:
                want[i, k] = round(s, 9)
    got = {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in Q.op9_decontaminate(spark, SF).collect()}
    assert got == want
