"""Training-data operators against brute force on small tables with nulls, empty and long texts, ties and repeats."""

import hashlib
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleanery.llm import mixing, packing, partenum, quality_knn, quality_rules, queries, repeats, secret_scan, topk, toxicity, url_rules

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, bucket int, rank int, key string"


def words(text):
    return WORD.findall(text or "")


def body(seed, n):
    return [f"w{(seed * 7919 + i * i * 31 + i) % 997}" for i in range(n)]


@pytest.fixture(scope="module")
def texts():
    base = body(1, 300)
    near = base.copy()
    near[40] = "changed"
    half = base[:150] + body(9, 150)
    return {
        1: " ".join(base), 2: " ".join(base), 3: " ".join(near), 4: " ".join(half), 5: None, 6: "", 7: " \n\t ", 8: "One two",
        9: "one\u00a0two", 10: "one TWO", 11: " ".join(body(3, 20_000)), 12: "\n".join(["same line of text"] * 60), 13: "É" * 5000,
        14: " ".join(body(5, 34)), 15: " ".join(body(5, 35)), 16: " ".join(body(5, 35)), 17: "a b\x0bc\x0cd\re f", 18: "x " * 3000,
    }


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", ("a", "b", None)[i % 3], len(t or ""), 0.5, 1, 2, "k") for i, t in texts.items()]
    return spark.createDataFrame([*rows, rows[0], (None, "no id here", None, None, None, None, None, None, None)], SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_secrets(spark, docs, empty):
    key = "AKIA" + "Q7Z2" * 4
    odd = "zQ9x+Lm3/Vb7Kp2Rt8Yw5Ns1"
    cases = {
        1: f'password = "abcdef123456" {key} {"0af1" * 5}', 2: "Token: short pass", 3: f"token=token={odd}", 4: None, 5: "AKIA" + "B" * 13,
        6: f"éé API_KEY:'x{'y' * 20}' {odd} plainwordthatisverylongindeed", 7: "f" * 15, 8: "f" * 16,
    }
    # The models need a corpus to learn from.
    corpus = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(F.col("doc_id") + 100, "text")
    rows = spark.createDataFrame(list(cases.items()), "doc_id long, text string").unionAll(corpus).withColumn("row_id", F.lit(0).cast("long"))
    found = {r.doc_id: r for r in secret_scan.report(secret_scan.secret_spans(rows)).collect()}
    for i, text in cases.items():
        base = secret_scan.base_spans(text or "")
        shown = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert found[i].base_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert [found[i].n_assign, found[i].n_access, found[i].n_hex] == [sum(k == n for _, k, _ in base) for n in range(3)]
    assert found[1].spans.startswith("assign:0:24,access:26:46,hex:47:67")
    assert found[6].n_markov == 1 and found[5].n_access == 0 and found[7].n_hex == 0 and found[8].n_hex == 1
    clean = secret_scan.redacted(docs).collect()
    assert sorted(map(str, clean)) == sorted(map(str, docs.collect()))
    assert secret_scan.redacted(rows.drop("row_id").withColumn("n_chars", F.length("text"))).where("text like '%abcdef123456%'").count() == 0
    assert secret_scan.redacted(empty).count() == 0


def test_random_parts_of_tokens_are_found(spark):
    rng = np.random.default_rng(4)
    letters = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"))
    plain = "users/home/projects/documents/the-long-name-of-a-project"
    keys = {i + n: "".join(rng.choice(letters, n)) for n in (16, 17, 18, 19, 24) for i in (100, 1100)}
    inside = {i: keys.pop(i) for i in [*keys] if i > 1000}
    hidden = {1: "deadbeefdeadbeefDEADBEEFCAFEBABE", 2: "Zk9" + "0a1f" * 4 + "Xw7Qp", 3: "qAKIA" + "Q7Z2" * 4 + "zT4bN8", **keys}
    cases = {**hidden, **{i: f"{plain}/{k}/{plain}" for i, k in inside.items()}, 5: plain, 6: f"see {plain} twice"}
    filler = [(10_000 + i, f"{plain} {plain.upper()} see twice {i % 7}") for i in range(300)]
    corpus = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(F.col("doc_id") + 100_000, "text")
    rows = spark.createDataFrame([*cases.items(), *filler], "doc_id long, text string").unionAll(corpus)
    spans = {r.doc_id: r.spans for r in secret_scan.secret_spans(rows.withColumn("row_id", F.lit(0).cast("long"))).collect()}
    found = {r.doc_id: r.text for r in secret_scan.redacted(rows).collect()}
    assert {i: found[i] for i in hidden} == dict.fromkeys(hidden, "[secret]")
    assert all(k not in found[i] and "[secret]" in found[i] for i, k in inside.items())
    assert all(found[i].startswith("users/home/projects/documents/") and found[i].endswith(plain[6:]) for i in inside)
    assert found[5] == plain and found[6] == f"see {plain} twice"
    assert all(a >= d or b <= c for i in hidden for a, k, b in spans[i] if k == 3 for c, o, d in spans[i] if o < 3)


def test_numbers_are_ordinary_and_random_strings_are_found(spark):
    rng = np.random.default_rng(6)
    letters = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"))
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    # Base patterns find none of them; every other text is as it was, with some numbers.
    planted = {10**6 + i: "".join(rng.choice(letters, 16 + i % 17)) for i in range(200)}
    numbers = {2 * 10**6 + i: f"in {1900 + i} there were {i * 37 % 10_000} of {i} and 3.{i}" for i in range(200)}
    rows = [(i, f"a line of text with {k} inside") for i, k in planted.items()] + list(numbers.items())
    both = docs.unionAll(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {r.doc_id: r for r in secret_scan.report(secret_scan.secret_spans(both.withColumn("row_id", F.lit(0).cast("long")))).collect()}
    assert sum(found[i].n_markov > 0 for i in planted) >= 0.9 * len(planted)
    assert not any(found[i].n_markov for i in numbers)
    clean = [r for i, r in found.items() if i < 10**6 and not r.n_assign + r.n_access + r.n_hex]
    assert len(clean) > 9000 and sum(r.n_markov for r in clean) <= len(clean) / 1000


def test_base_patterns_as_the_contract_spells_them():
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    rng = np.random.default_rng(8)
    parts = ["password", "Token", "API_KEY", "apikey", "=", ": ", '"', "'", " ", "AKIA", "Q7Z2" * 4, "0af1" * 4, "x/y+z_.=-", "é", "\n", "f" * 15]
    for _ in range(2000):
        text = "".join(rng.choice(parts, rng.integers(0, 14)))
        want = [(m.start(), 0, m.end()) for m in re.finditer(assign, text, re.I | re.A) if len(m.group(2)) >= 12]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]
        assert secret_scan.base_spans(text) == sorted(want)


def test_runs_above_the_threshold():
    rng = np.random.default_rng(5)
    for _ in range(200):
        ratios = rng.normal(0, 4, 40)
        sums = np.concatenate([[0], np.cumsum(ratios)])
        best = max(sums[j] - sums[i] for i in range(41) for j in range(i, 41))
        runs = secret_scan.random_runs(ratios, 14.0)
        assert bool(runs) == (best > 14) and all(ratios[a : b + 1].sum() > 14 for a, b in runs)
        assert all(a[1] < b[0] for a, b in zip(runs, runs[1:]))


def test_targets_and_permutation():
    assert mixing.targets([10, 10], [3, 1]) == [20, 10]
    assert mixing.targets([100, 0, 50], [1, 1, 1]) == [125, 0, 100]
    for n in (1, 2, 7, 1000):
        there = mixing.permuted(np.arange(n), n, 5)
        assert sorted(there) == list(range(n))
        assert (mixing.permuted(there, n, 5, back=True) == np.arange(n)).all()
    slots = np.array([1000, 0, 77, 5000])
    shards = [mixing.shard_counts(slots, s, 64, 3) for s in range(-(-6077 // 64))]
    assert sum(c for c, _ in shards).tolist() == slots.tolist()
    assert all(c.sum() == 64 for c, _ in shards[:-1])


def test_draws_of_large_parts_are_whole(monkeypatch):
    slots = np.array([100_000, 0, 77, 50_000, 3])
    monkeypatch.setattr(mixing, "DRAWN_SLOTS", 1000)
    monkeypatch.setattr(mixing, "RARE", 1000)
    shards = [mixing.shard_counts(slots, s, 4096, 3)[0] for s in range(-(-int(slots.sum()) // 4096))]
    assert sum(shards).tolist() == slots.tolist() and all(c.sum() == 4096 and (c >= 0).all() for c in shards[:-1])
    share = np.array([c[0] for c in shards[:-1]]) / 4096
    # The spread of independent draws, not of equal shares.
    assert abs(share.mean() - 100_000 / slots.sum()) < 0.02 and 0.002 < share.std() < 0.03


def test_slots_are_not_broadcast(docs):
    plan = mixing.mix_sources(docs).pieces._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and not re.search(r"BroadcastExchange[^\n]*\n[^\n]*(\n[^\n]*)?MapInPandas", plan)


def test_columns_that_clash_with_working_names(spark):
    import corpus_pipeline

    names = ["spans", "row_id", "pieces", "text_id", "_row", "row", "predicted", "component_id"]
    text = " ".join(body(31, 120)) + " token=abcdefghijkl0123"
    rows = [(i, t, "s", *[f"{n}{i}" for n in names]) for i, t in enumerate([text, text, " ".join(body(32, 90)), None, ""])]
    docs = spark.createDataFrame([*rows, rows[0]], ", ".join(f"{n} string" if n != "doc_id" else "doc_id long" for n in ["doc_id", "text", "source", *names]))
    for _, step in corpus_pipeline.STAGES[:4]:
        for table in (docs, docs.limit(0)):
            out = step(spark, table, SF)
            assert out.columns == docs.columns
            for row in out.collect():
                assert [row[n] for n in names] == [f"{n}{row.doc_id}" for n in names]
    assert corpus_pipeline.pack_sequences(spark, docs, SF).count() == 6


def test_mixing(docs, empty, texts):
    def run():
        return mixing.taken(mixing.mix_sources(docs, block=16, shard_slots=32)).drop("row_id", "text_id").toPandas()

    rows = run()
    assert sorted(rows["size"]) == sorted(len(words(r.text)) for r in docs.collect())
    assert (rows["taken"] <= 2 * rows["size"]).all()
    for _, group in rows.groupby("source", dropna=False):
        assert abs(group["taken"].sum() - group["target"].iloc[0]) <= 0.5
    order = list(rows.columns)
    assert sorted(map(str, rows[order].values.tolist())) == sorted(map(str, run()[order].values.tolist()))
    made = mixing.mixed_documents(docs, block=16, shard_slots=32).toPandas()
    assert sum(len(words(t)) for t in made["text"]) == rows["taken"].sum()
    assert all(t in texts.get(i, "no id here") for i, t in zip(made["doc_id"].fillna(-1), made["text"]))
    assert mixing.taken(mixing.mix_sources(empty)).count() == 0


def test_quality_held_out(spark):
    rows = queries.op3_quality_classifier(spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    assert len(rows) == 1000 and rows["score"].between(0, 1).all()
    assert (rows["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in rows["doc_id"]]).all()
    held = rows[rows["held_out"]].merge(labels, on="doc_id")
    assert (held["predicted"] == held["quality"]).mean() >= 0.93


@pytest.mark.parametrize("labels", ["some", "none"])
def test_classifiers_on_odd_rows(spark, docs, empty, labels):
    marked = [(i, i % 2, i % 2) for i in range(1, 19)] if labels == "some" else []
    table = spark.createDataFrame([*marked, (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    model = quality_knn.train(docs.select("doc_id", "text"), table)
    assert quality_knn.scored(docs, model).where("score between 0 and 1").count() == docs.count()
    assert quality_knn.scored(empty, model).count() == 0
    model = toxicity.train(docs, table)
    assert toxicity.scored(docs, model).where("score between 0 and 1").count() == docs.count()
    assert toxicity.scored(empty, model).count() == 0


def test_url_rules(spark):
    rules = spark.createDataFrame([*queries.URL_RULES, ("b.example.net", "/", "block"), (None, "/", "block")], "host string, path string, action string")
    urls = ["http://EXAMPLE.net/en/x", "https://a.b.example.net/en/", "x://b.example.net/de", "http://example.net/enough", "http://badexample.net/q",
            "http://example.com/de/?q", "http://org/fr/#x", "http://x.org?fr", None, "", "no scheme", "://", "http://net", "a://b://c/d", "http://Ünet/x"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls * 3)], "page_id long, url string, host string")
    found = url_rules.apply_rules(pages, rules).collect()
    assert len(found) == len(urls) * 3
    table = [r for r in map(tuple, rules.collect()) if r[0]]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for row in found:
        url = urls[row.page_id % len(urls)] or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = host.translate(lower)
        fits = [(len(h + p), len(h), h + p, a) for h, p, a in table if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want = max(fits)[2:] if fits else (None, "allow")
        assert (row.host, row.path, row.rule, row.verdict) == (host, path, *want)
    assert url_rules.apply_rules(pages.limit(0), rules).count() == 0


def test_repeats(docs, empty):
    counts = Counter()
    rows = [(r.doc_id, words(r.text)) for r in docs.collect()]
    for _, w in rows:
        counts.update(tuple(w[i : i + 35]) for i in range(len(w) - 34))
    want = []
    for doc_id, w in rows:
        gone = {j for i in range(len(w) - 34) if counts[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
        want.append((str(doc_id), len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    found = [(str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in repeats.without_repeats(docs).collect()]
    assert sorted(found) == sorted(want)
    assert repeats.without_repeats(empty).count() == 0


def test_topk(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).round(2).tolist(), 1) for i in range(300)] + [(301, None, 1), (302, [1.0, None], 1), (303, [float("nan")] * 8, 1), (304, [float("inf")], 1)]
    rows += [(i + 400, rows[i][1], 1) for i in range(40)] + [(7, rows[7][1], 1), (900, [-1.5] * 3, 1), (None, [1.0] * 8, 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    found = topk.nearest(table, table.where("vec_id % 100 = 0"), block=64)
    whole = [(i, np.pad(np.floor(np.array(v) * 1024), (0, 8 - len(v))).astype(int)) for i, v, _ in rows if i is not None and i not in (301, 302, 303, 304)]
    want = []
    for q, x in whole:
        if q % 100 == 0:
            best = sorted((-int(x @ y), i) for i, y in whole if i != q)[:10]
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()) == sorted(want)
    assert topk.nearest(table.limit(0), table.limit(0)).count() == 0


@pytest.mark.parametrize("scale", [1, 10**4])
def test_lists_read_together_give_the_best_of_each_query(scale):
    rng = np.random.default_rng(7)
    for rows, width, spread in ((1, 3, 5), (9, 4, 2), (700, 6, 3), (700, 16, 1000)):
        values, asked = (rng.integers(-spread, spread + 1, (n, width)) * scale * 10 for n in (rows, 20))
        ids, own = rng.permutation(rows), rng.integers(0, rows, 20)
        found = {q: (at, scores) for q, at, scores in topk._read_lists(values, ids, asked, own, 10)}
        for q in range(20):
            want = sorted((-int(x), i) for x, i in zip(values @ asked[q], ids) if i != own[q])[:10]
            assert [(-int(s), ids[a]) for a, s in zip(*found[q])] == want


def test_quality_rules(docs, empty):
    found = {(str(r.doc_id), r.n_words): r for r in quality_rules.judged(docs).collect()}
    for row in docs.collect():
        text, w = row.text or "", words(row.text)
        runs = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        again = {j for i in range(len(w) - 2) if runs[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
        lines = [x for x in text.split("\n") if words(x)]
        got = found[(str(row.doc_id), len(w))]
        assert (got.word_chars, got.n_dup_lines, got.n_repeat_words) == (sum(map(len, w)), len(lines) - len(set(lines)), len(again))
        assert got.base_failed == (len(w) < 50 or 100 * len(again) > 50 * len(w)) and not (got.base_failed and got.kept)
    assert quality_rules.judged(empty).count() == 0
    plan = quality_rules.judged(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_packing_plan_is_whole_and_tight():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 400, 20_000):
        lengths = rng.integers(1, 1025, n)
        histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)))) if n else {}
        plan, seen = packing.packing_plan(histogram), Counter()
        for bins, inside in plan:
            assert bins > 0 and sum(inside) <= 1024
            for length in inside:
                seen[length] += bins
        assert seen == Counter(histogram)
        assert sum(b for b, _ in plan) <= 1.02 * lengths.sum() / 1024 + 6


def test_packing_round_trip(docs, empty):
    from tokenizers import Tokenizer

    path = queries.tokenizer()
    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    found = packing.pack_documents(docs, path, keep_ids=True).toPandas()
    for row in docs.where("doc_id > 1").collect():
        pieces = found[found["doc_id"] == row.doc_id].sort_values("piece")
        ids = np.concatenate(pieces["ids"].to_list())
        assert ids.tolist() == [*model.encode(row.text or "", add_special_tokens=False).ids, 2]
        assert (pieces["length"].iloc[1:] == 1024).all() and (pieces["start"] == pieces["length"].cumsum() - pieces["length"]).all()
        assert all(zlib.crc32(np.array(i, "<u4").tobytes()) == c for i, c in zip(pieces["ids"], pieces["ids_crc32"]))
    found = found.sort_values(["sequence_id", "offset"])
    ends = found.groupby("sequence_id")["length"].cumsum()
    assert (ends - found["length"] == found["offset"]).all() and ends.max() <= 1024
    assert packing.pack_documents(empty, path).count() == 0


@pytest.mark.parametrize("text", ["<|endoftext|> x", " " * 20_000, "a" * 5000, "é\u00a0ß\u2028 't'll", "\x00\ufffd😀", "12345 !!! \r\n\n"])
def test_ids_equal_the_tokenizers_library(text):
    encoder = packing.Encoder(queries.tokenizer())
    assert encoder.ids(text) == encoder.slow_ids(text)


@pytest.mark.parametrize("text", ["a <|endoftext|> x", "<|endoftext|>", "a  <|endoftext|>\n<|endoftext|><|endoftext|>é", "<|endoftext| >", "plain text"])
def test_added_tokens_get_their_id(spark, text):
    from tokenizers import Tokenizer

    path = queries.tokenizer()
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert packing.Encoder(path).ids(text) == want
    found = packing.pieces_of(spark.createDataFrame([(1, text)], "doc_id long, text string"), path, keep_ids=True).collect()
    assert [(r.start, r.length, r.ids) for r in found] == [(0, len(want) + 1, [*want, 2])]


def test_jaccard_components(docs, empty, texts):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, text in texts.items():
        w = words((text or "").translate(lower))
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()
    parent = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    parent[a] = parent[b] = min(parent[a], parent[b])
    found = {(r.doc_id, r.n_shingles, r.component_id) for r in partenum.jaccard_components(docs).collect() if r.doc_id is not None}
    assert found == {(i, len(sets[i]), parent[i]) for i in sets}
    assert partenum.jaccard_components(empty).count() == 0


def test_equal_rows_make_one_link(spark):
    one = body(41, 200)
    two = [*one[:-4], "other", "words", "at", "last"]
    rows = [(1, " ".join(one))] * 300 + [(2, " ".join(two))] * 300 + [(2, "one more text of this document")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    name = lambda words_: partenum.set_names(next(partenum.shingle_sets(pa.array([" ".join(words_)]))))[0]
    facts = [(name(w), i, 196, partenum.sketch_of(next(partenum.shingle_sets(pa.array([" ".join(w)]))))) for i, w in ((1, one), (2, two))]
    classes = spark.createDataFrame(facts, "name long, rep long, n long, sketch binary")
    pairs = spark.createDataFrame([(name(one), name(two))], "a long, b long")
    assert [sorted(r) for r in partenum.verified(docs, pairs, classes).collect()] == [[1, 2]]
    assert {r.component_id for r in partenum.jaccard_components(docs).where("n_shingles > 100").collect()} == {1}


@pytest.mark.parametrize("earlier", [1, 12])
def test_sets_near_the_threshold_keep_every_link(spark, monkeypatch, earlier):
    monkeypatch.setattr(partenum, "EARLIER", earlier)
    rng, base, texts = np.random.default_rng(9), body(51, 120), []
    for i in range(80):
        words_ = list(base)
        for at in rng.choice(120, rng.integers(1, 5), replace=False):
            words_[at] = f"v{i}x{at}"
        texts.append(words_)
    sets = [{tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in texts]
    linked = [(a, b) for a in range(80) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    least = list(range(80))
    for _ in range(80):
        for a, b in linked:
            least[a] = least[b] = min(least[a], least[b])
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in partenum.jaccard_components(docs).collect()} == dict(enumerate(least))
    assert len(set(least)) > 1


def test_percent_below_the_bands_is_refused():
    for percent in (63, 50, 0, 101):
        with pytest.raises(ValueError):
            partenum.jaccard_components(None, percent=percent)
    for n in range(1, 5000):
        band = lambda size: int(np.searchsorted(partenum._EDGES, size, side="right"))
        assert band(n * 100 // partenum.LEAST_PERCENT) - band(n) <= 1


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(2)
    for n in [*range(1, 60), 120, 300, 1000]:
        for _ in range(8):
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            lost = rng.integers(0, partenum.difference(len(a), len(a)) + 1)
            b = np.unique(np.concatenate([a[rng.permutation(len(a))[lost // 2 :]], rng.integers(0, 2**63, lost - lost // 2).astype(np.uint64)]))
            if 100 * len(np.intersect1d(a, b)) < 80 * len(np.union1d(a, b)) or np.array_equal(a, b):
                continue
            (one, spare_a), (two, spare_b) = partenum.signatures(a), partenum.signatures(b)
            assert len(np.intersect1d(one, two)) > max(spare_a, spare_b)
            assert partenum.least_difference(partenum.sketch_of(a), partenum.sketch_of(b)) <= len(np.setxor1d(a, b))


def test_parities_never_exceed_the_difference(spark):
    rng, rows = np.random.default_rng(3), []
    for n in [*range(1, 60), 120, 300, 1000]:
        a = np.unique(partenum.mix(rng.integers(0, 2**63, n).astype(np.uint64)))
        b = np.unique(np.concatenate([a[: n - n // 10], partenum.mix(rng.integers(0, 2**63, n // 8 + 1).astype(np.uint64))]))
        rows.append((partenum.parity_bits(a).tolist(), partenum.parity_bits(b).tolist(), len(np.setxor1d(a, b))))
    table = spark.createDataFrame(rows, "a array<long>, b array<long>, n int")
    found = table.select(partenum.least_odd(F.col("a"), F.col("b")).alias("least"), "n").collect()
    assert all(0 <= r.least <= r.n for r in found)


def test_short_parities_rule_pairs_out_before_arrays_are_made(spark):
    rng, rows = np.random.default_rng(4), []
    for n in (40, 60, 130, 300, 1000):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        near = np.unique(np.concatenate([a[n // 20 :], rng.integers(0, 2**63, n // 20).astype(np.uint64)]))
        for b in (near, np.unique(rng.integers(0, 2**63, n + 8).astype(np.uint64))):
            short = [partenum.short_parities(partenum.parity_bits(x)) for x in (a, b)]
            assert all((x is None) == (len(y) <= 64) for x, y in zip(short, (a, b)))
            if short[0] is not None and short[1] is not None:
                assert np.bitwise_count((short[0] ^ short[1]).view(np.uint64)).sum() <= len(np.setxor1d(a, b))
            # No other parities: what is ruled out here is ruled out by the short ones.
            sides = [(len(x), [0], *([None] * partenum.SHORT if y is None else y.tolist())) for x, y in zip((a, b), short)]
            rows.append((*sides, b is near))
    side = "struct<n long, bits array<long>, " + ", ".join(f"short{i} long" for i in range(partenum.SHORT)) + ">"
    table = spark.createDataFrame(rows, f"one {side}, two {side}, near boolean")
    found = table.select("one.n", "near", partenum._may_link("one.", "two.", 80).alias("may")).collect()
    assert [r.may for r in found] == [r.near or r.n <= 64 for r in found]


def test_decoding():
    corpus = "the idiot was a stupid clown and the moron is pathetic and the loser of the trash bag " * 50
    data = np.frombuffer(corpus.encode(), np.uint8)
    model = toxicity.language_model(toxicity.trigram_counts(data, np.array([0, len(data)])))
    for disguised, plain in {"1d10t": "idiot", "m0r0n": "moron", "stuuuupid": "stupid", "c l o w n": "clown", "t.r.a.s.h": "trash", "idiot": "idiot"}.items():
        assert toxicity.decoded(disguised, model) == plain


DISGUISED = ["idio+", "a$$", "cla$$", "iddioot", "i--d--i--o--t", "i.. d.. i.. o.. t", "id i ot", "o i d", "he is an id i ot", "\u00e9\u00e9n"]


@pytest.mark.parametrize("text", DISGUISED)
def test_strings_the_lattice_could_change_are_suspects(text):
    found = toxicity.suspects(pa.array(["plain words here", text, None, f"{text}\nplain", "much, 1984 done."]))
    assert found[0] == found[2] == found[4] == []
    assert text in found[1] and text in found[3]


def test_a_word_behind_many_characters_is_read_whole():
    corpus = "the idiot was a stupid clown and the moron is pathetic and the loser of the trash bag " * 50
    data = np.frombuffer(corpus.encode(), np.uint8)
    model = toxicity.language_model(toxicity.trigram_counts(data, np.array([0, len(data)])))
    for lead in range(40, 50):
        assert toxicity.decoded("," * lead + "st0pidm0r0n", model).split()[-1].endswith("moron")
        assert toxicity.decoded("," * lead + "stuuupid", model).split()[-1] == "stupid"
    costs = (-model).ravel().tolist()
    assert "idiot" in toxicity.restored("is an id i ot", costs).split()
    assert len(toxicity.decoded("i.d.1.0.t," * 20_000, model).split()) == 20_000


def test_different_texts_are_all_learnt_from():
    shared = "all of them have this same line"
    texts = ["idiot", "moron", "Idiot", "you clown", "you moron", *(f"{shared} text{i}" for i in range(50)), f"{shared}  TEXT7", "", None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([1] * len(texts), pa.int32())], names=["text", "label"])
    marks = [m for out in toxicity._marked(iter([batch])) for m in out.column("mark").to_pylist()]
    assert len(marks) == len(texts) and len(set(marks)) == 55
    assert marks[0] == marks[2] and marks[12] == marks[55] and marks[56] == marks[57]


def test_toxicity_held_out(spark):
    rows = queries.op10_toxicity(spark, "/root/testdata/sf0.1").toPandas()
    held = rows[rows["held_out"]].merge(spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas(), on="doc_id")
    assert len(rows) == 10_000 and (held["predicted"] == held["toxic"]).mean() >= 0.95
    print("toxic rows missed", ((held["toxic"] == 1) & (held["predicted"] == 0)).sum(), "of", held["toxic"].sum(), "others flagged", ((held["toxic"] == 0) & (held["predicted"] == 1)).sum())


def test_a_disguised_word_adds_to_plain_ones(spark):
    plain = [(i, f"this clown is an idiot and a moron number {i}", 1) for i in range(0, 90, 3)]
    clean = [(i, f"this paper is about music and the weather number {i}", 0) for i in range(300, 900, 3)]
    rows = [(i, t, y) for i, t, y in plain + clean if zlib.crc32(str(i).encode()) % 3 != 1]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    model.prior = -4.0 - max(model.weights)
    shown, mixed, one = model.score(pa.array(["idiot moron", "idiot m0r0n", "idiot"]), {})
    assert abs(shown - mixed) < 1e-9 and mixed > one


def test_each_group_of_texts_keeps_a_row(spark):
    import corpus_pipeline

    one, two, three = (" ".join(body(seed, 100)) for seed in (21, 22, 23))
    rows = [(3, one), (5, one), (5, two), (9, two), (5, three), (5, three), (None, one), (None, one), (7, None), (7, ""), (8, "")]
    found = corpus_pipeline.one_of_each_group(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    want = [(3, one), (5, two), (5, three), (None, one), (None, one), (7, None), (7, ""), (8, "")]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [f for _, f in corpus_pipeline.STAGES]
    assert len(names) == 5
    good = names[0](spark, docs, SF).cache()
    groups = {r.doc_id: r.component_id for r in partenum.jaccard_components(good).collect()}
    once = names[1](spark, good, SF).cache()
    assert sorted(r.doc_id for r in once.collect()) == sorted({min(j for j in groups if groups[j] == c) for c in set(groups.values())})
    hidden = names[2](spark, once, SF)
    for row, old in zip(hidden.orderBy("doc_id").collect(), once.orderBy("doc_id").collect()):
        assert row.doc_id == old.doc_id and (secret_scan.base_spans(old.text) or row == old)
        assert not secret_scan.base_spans(row.text)
    assert good.columns == once.columns == hidden.columns == docs.columns == names[3](spark, hidden, SF).columns
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_quality_stage_sends_texts_once_in_short_batches(spark, monkeypatch):
    import corpus_pipeline
    from gleanery.llm import quality_knn

    seen = []
    plain = quality_knn.scored

    def scored(docs, model, *more):
        seen.append(docs.schema.simpleString().count("text:"))
        return plain(docs, model, *more).withColumn("predicted", F.lit(1))

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    write = corpus_pipeline.stage
    monkeypatch.setattr(quality_knn, "scored", scored)
    monkeypatch.setattr(corpus_pipeline, "stage", lambda df, label: (seen.append(int(spark.conf.get(key))), write(df, label))[1])
    rows = [(3, "some words", "x", None), (3, "some words", "x", None), (None, None, None, 2), (4, "", "y", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, TEXT string, `a b` string, row int")
    kept = corpus_pipeline.keep_quality(spark, docs, SF)
    assert seen == [1, 1024]
    assert kept.schema == docs.schema
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))


@pytest.mark.parametrize("step", [quality_knn._counts, partenum._sets(5)])
def test_pipeline_steps_hold_little_beside_a_batch(step):
    texts = pa.array([" ".join(body(seed, 600)) for seed in range(1500)])
    columns = {"doc_id": pa.array(range(1500), pa.int64()), "text": texts, "label": pa.array([0] * 1500, pa.int32())}
    batch = pa.RecordBatch.from_pydict(columns)
    tracemalloc.start()
    try:
        rows = sum(out.num_rows for out in step(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 1500 and texts.nbytes > 4 << 20
    assert peak < 40 << 20


def test_scans_and_packing_send_texts_in_short_batches(docs, monkeypatch):
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", {}
    conf = docs.sparkSession.conf
    for module, name in ((secret_scan, "stage"), (secret_scan, "staged_count"), (packing, "stage")):
        write = getattr(module, name)
        monkeypatch.setattr(module, name, lambda df, label, write=write: (seen.update({label: conf.get(key)}), write(df, label))[1])
    before = conf.get(key)
    secret_scan.redacted(docs)
    packing.pack_documents(docs, queries.tokenizer())
    assert seen == {"secrets": "1024", "secret-spans": "1024", "pieces": "1024"}
    assert conf.get(key) == before
