"""The queries of the text operators on the driver tables: against SQL, brute force, or the library they follow."""

import os

import brute
import pytest
from compare import connect, difference

from modelkit.llm.oracles import ORACLES
from modelkit.llm.queries import QUERIES

ROOT = os.environ.get("TESTDATA", "/root/testdata")
SF = f"{ROOT}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def docs(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def rows(spark, name):
    return QUERIES[name](spark, SF).collect()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_statement(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


def test_substring_dedup(spark, docs):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows(spark, "op1_substring_dedup")}
    assert got == brute.substrings(docs)


def test_quality_rules(spark, docs):
    want = {i: brute.statistics(t) for i, t in docs}
    got = rows(spark, "op2_quality_rules")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert {r["doc_id"]: tuple(r[c] for c in names) for r in got} == want
    assert not any(r["kept"] and r["base_failed"] for r in got)
    good = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    judged = [(r["kept"], good[r["doc_id"]]) for r in got if r["doc_id"] in good and not r["base_failed"]]
    assert sum(kept == bool(q) for kept, q in judged) >= 0.95 * len(judged)


def test_source_mixing(spark, docs):
    got = rows(spark, "op3_source_mixing")
    size = {i: len(brute.words(t)) for i, t in docs}
    assert {r["doc_id"]: r["size"] for r in got} == size
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    taken, target = {}, {}
    for r in got:
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
    assert abs(sum(target.values()) - sum(size.values())) < 1e-6 * sum(size.values())
    assert all(abs(taken[s] - target[s]) <= 130 for s in target)
    again = {(r["doc_id"], r["taken"]) for r in rows(spark, "op3_source_mixing")}
    assert again == {(r["doc_id"], r["taken"]) for r in got}


def test_personal_data(spark, docs):
    want = {i: brute.personal(t) for i, t in docs}
    for r in rows(spark, "op4_pii"):
        base = ",".join(s for s in r["spans"].split(",") if s and not s.startswith("crf_"))
        assert base == want[r["doc_id"]]
        assert r["base_sha256"] == brute.sha(base)
        assert r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] == (base.count(",") + 1 if base else 0)


def test_jaccard_join(spark, docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(spark, "op5_jaccard_join")}
    assert got == brute.near(docs)


def test_decontamination(spark, docs):
    items = {r["item_id"]: brute.tokens(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    want = {}
    for i, text in docs:
        t = brute.tokens(text)
        grams = {tuple(t[k : k + 5]) for k in range(len(t) - 4)}
        for item, tokens in items.items():
            if any(tuple(tokens[k : k + 5]) in grams for k in range(len(tokens) - 4)):
                covered = brute.tiling(t, tokens)
                if covered >= 0.8 * len(tokens):
                    want[i, item] = (len(tokens), covered)
    got = {(r["doc_id"], r["item_id"]): (r["item_tokens"], r["covered"]) for r in rows(spark, "op7_decontamination")}
    assert got == want and got


def test_token_counts(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: (len((t or "").encode()), len(model.encode(t or "", add_special_tokens=False))) for i, t in docs}
    got = rows(spark, "op8_token_counts")
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in got} == want
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got)


def test_page_text(spark):
    import html
    import re

    want = {}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        article = r["html"].partition("<article>")[2].partition("</article>")[0]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", article.replace("<br>", " ")))
        texts = [" ".join(html.unescape(b).split()) for b in blocks]
        want[r["page_id"]] = "\n".join(t for t in texts if t)
    got = rows(spark, "op9_html_extraction")
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_ranked_search(spark, docs):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {}
    for r in rows(spark, "op11_ranked_search"):
        got.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    assert {i: sorted(found) for i, found in got.items()} == {i: f for i, f in brute.ranked(docs, items).items() if f}


def test_fill_in_middle(spark, docs):
    assert {tuple(r) for r in rows(spark, "op12_fill_in_middle")} == {brute.middle(i, t) for i, t in docs}


def test_bpe_round_trip(spark, docs):
    import hashlib

    import public_tokenizers
    import tiktoken
    from modelkit.llm import bpe

    ranks = {t: r for r, t in enumerate(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))}
    model = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = set()
    for i, t in docs:
        ids = model.encode_ordinary(t or "")
        want.add((i, len(ids), brute.sha(" ".join(map(str, ids))), hashlib.sha256((t or "").encode()).hexdigest()))
    assert {tuple(r) for r in rows(spark, "op13_bpe_round_trip")} == want
