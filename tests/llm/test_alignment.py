"""Alignment of two tokenizers against the tokenizers themselves and set-by-set comparison in plain Python."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleanery.llm import alignment, queries
from gleanery.llm.alignment import Both, aligned, diagonal, merge
from gleanery.llm.packing import _byte_letters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain():
    """Ids of both tokenizers, straight from their libraries."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = _byte_letters()

    def ids(text):
        return a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)

    def joined(x, y):
        left = b"".join(bytes(letters[c] for c in a.id_to_token(i)) for i in x)
        return left, b"".join(bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in y for p in [b.id_to_piece(i)])

    def spans(values, sizes):
        ends = np.cumsum([sizes(i) for i in values]).tolist()
        return list(zip([0, *ends], ends))

    def tokens(text):
        x, y = ids(text) if text else ([], [])
        left, right = joined(x, y)
        if not text or left != (" " + text).encode() or right != left:
            return [], [], [], []
        return x, y, spans(x, lambda i: len(joined([i], [])[0])), spans(y, lambda i: len(joined([], [i])[1]))

    return tokens


def expected(texts, tokens):
    """Rows of the operator by comparing every A token with every B token nearby."""
    found, documents = [], Counter()
    for text in texts:
        x, y, a, b = tokens(text)
        links, groups, start = [], [], [0, 0]
        at = 0
        for i, (lo, hi) in enumerate(a):
            while at < len(b) and b[at][1] <= lo:
                at += 1
            j = at
            while j < len(b) and b[j][0] < hi:
                links.append((x[i], y[j]))
                j += 1
        ends_b = {hi: j for j, (_, hi) in enumerate(b)}
        for i, (_, hi) in enumerate(a):
            if hi in ends_b:
                groups.append((x[start[0] : i + 1], y[start[1] : ends_b[hi] + 1]))
                start = [i + 1, ends_b[hi] + 1]
        found.append((x, y, links, groups))
        documents.update(set(links))
    most = defaultdict(int)
    for (i, _), n in documents.items():
        most[i] = max(most[i], n)
    out = []
    for x, y, links, groups in found:
        shown = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in groups)
        best = sum(documents[link] == most[link[0]] for link in links)
        digest = hashlib.sha256(shown.encode()).hexdigest() if shown else ""
        out.append((len(x), len(y), len(groups), len(links), best, sum(documents[link] for link in links), digest))
    return out


ODD = [
    None, "", " ", "\n", "word", " word", "two words", "two  words", "tab\tand\r\nline", "a\n\nb", "\nstart", "end ", "don't we'll",
    "naïve café 日本語 🙂 é", "▁ is a piece", "<|endoftext|> <s> <unk> <0x41>", " nbsp　wide ", "ﬁ ligature", "x" * 300,
    "1234567890 3.14159", "same text twice", "same text twice", "a\x00b\x1cc", "line one\nline two\nline three", "word\n three", "­​zero",
]


def rows_of(frame):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], *(r[c] for c in COLUMNS)) for r in frame.collect())


def test_rows_equal_brute_force(spark, plain):
    texts = [*ODD, " ".join(f"w{i * i % 977} the of" for i in range(4000)), None]
    rows = [(n if n else None, t, 7, "x", 1, 2) for n, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row long, pairs string, piece int, n_a int")
    wanted = sorted((n if n else -1, *e) for n, e in enumerate(expected(texts, plain)))
    assert rows_of(aligned(docs, A, B)) == wanted
    # Many pieces a text, counts joined instead of looked up, and sums passed on early.
    assert rows_of(aligned(docs, A, B, piece=7, frequent=3, pending=50)) == wanted
    assert rows_of(aligned(docs, A, B, piece=64, frequent=0)) == wanted


def test_groups_are_returned_whole(spark, plain):
    docs = spark.createDataFrame([(1, "unbelievable tokenizers"), (2, "")], "doc_id long, text string")
    found = {r.doc_id: r for r in aligned(docs, A, B, piece=2, keep_groups=True).collect()}
    x, y, _, _ = plain("unbelievable tokenizers")
    left, right = zip(*(g.split("|") for g in found[1].groups.split(";")))
    assert [int(i) for g in left for i in g.split(",")] == x and [int(i) for g in right for i in g.split(",")] == y
    assert hashlib.sha256(found[1].groups.encode()).hexdigest() == found[1].groups_sha256
    assert found[2].groups == found[2].groups_sha256 == ""


def test_an_empty_table_gives_no_rows(spark):
    assert aligned(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0


def test_the_query_over_whole_tables(spark, plain):
    sf = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    wanted = sorted((t.doc_id, *e) for t, e in zip(texts, expected([t.text for t in texts], plain)))
    assert rows_of(queries.op12_token_alignment(spark, sf)) == wanted


def test_tokens_by_word_equal_those_of_the_whole_text(plain):
    both = Both(A, B, remembered=40)
    texts = [t for t in ODD if t] + ["repeated words and words repeated", "a\nb c\nd"]
    for part in (texts, texts[::-1]):
        a, b = both.encode(part)
        for n, text in enumerate(part):
            x, y, spans_a, spans_b = plain(text)
            assert a.ids[a.first[n] : a.first[n + 1]].tolist() == x and b.ids[b.first[n] : b.first[n + 1]].tolist() == y
            for side, spans in ((a, spans_a), (b, spans_b)):
                ends = side.ends[side.first[n] : side.first[n + 1]]
                assert (ends - (ends[-1] if len(ends) else 0)).tolist() == [e - spans[-1][1] for _, e in spans]


words = st.text(st.sampled_from(list("ab'. \n\t1é▁ 日")), max_size=25)


@settings(max_examples=150, deadline=None)
@given(st.lists(words, min_size=1, max_size=4))
def test_odd_spaces_are_encoded_as_by_the_libraries(plain, texts):
    a, b = _shared().encode(texts)
    for n, text in enumerate(texts):
        x, y, _, _ = plain(text)
        assert a.ids[a.first[n] : a.first[n + 1]].tolist() == x and b.ids[b.first[n] : b.first[n + 1]].tolist() == y


_kept = []


def _shared():
    if not _kept:
        _kept.append(Both(A, B))
    return _kept[0]


ends = st.lists(st.integers(1, 40), min_size=1, max_size=30, unique=True).map(sorted)


@settings(max_examples=200, deadline=None)
@given(ends, ends, st.integers(1, 12))
def test_pieces_merge_like_the_whole(a, b, size):
    top = max(a[-1], b[-1])
    a_ends, b_ends = (np.array(sorted({*e, top})) for e in (a, b))
    a_ids, b_ids = np.arange(len(a_ends), dtype=np.int32), np.arange(len(b_ends), dtype=np.int32) + 100
    side = lambda ids, e: alignment.Side(ids, e, np.array([0, len(ids)]))
    links, rows = [], []
    for part in alignment._slices(side(a_ids, a_ends), side(b_ids, b_ends), 0, size):
        own_a, own_b = part["own_a"], part["own_b"]
        assert own_a + own_b <= size
        x, y = alignment._read(part["a_ids"]), alignment._read(part["b_ids"])
        found = merge(x, alignment._ends(part, "a"), y, alignment._ends(part, "b"), own_a, own_b, part["before"])
        links += zip(found.a.tolist(), found.b.tolist())
        cuts = list(zip(found.cut_a.tolist(), found.cut_b.tolist()))
        (fa, fb), (la, lb) = (cuts[0], cuts[-1]) if cuts else ((own_a, own_b),) * 2
        body = "".join(f"{','.join(map(str, x[p:q]))}|{','.join(map(str, y[r:s]))};" for (p, r), (q, s) in zip(cuts, cuts[1:]))
        rows.append((part["piece"], len(cuts), *map(alignment._small, (x[:fa], y[:fb])), body, *map(alignment._small, (x[la:own_a], y[lb:own_b]))))
    starts = lambda e: [0, *e[:-1]]
    wanted = [(i, 100 + j) for i, (p, q) in enumerate(zip(starts(a_ends), a_ends)) for j, (r, s) in enumerate(zip(starts(b_ends), b_ends)) if p < s and r < q]
    assert sorted(links) == sorted(wanted)
    shown = alignment.stitched(pd.DataFrame(rows[::-1], columns=["piece", "n_groups", "head_a", "head_b", "body", "tail_a", "tail_b"]))
    both = sorted(set(a_ends.tolist()) & set(b_ends.tolist()))
    edges = lambda e: [0, *(e.tolist().index(v) + 1 for v in both)]
    groups = [(a_ids[p:q], b_ids[r:s]) for p, q, r, s in zip(edges(a_ends), edges(a_ends)[1:], edges(b_ends), edges(b_ends)[1:])]
    assert shown == ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in groups)


@settings(max_examples=100, deadline=None)
@given(ends, ends)
def test_diagonals_count_as_a_full_merge(a, b):
    merged = sorted([(v, 0) for v in a] + [(v, 1) for v in b])
    steps = np.arange(len(merged) + 1)
    assert diagonal(np.array(a), np.array(b), steps).tolist() == [sum(side == 0 for _, side in merged[:n]) for n in steps]
