"""Lexical search, spelling variants and fingerprints: brute force and odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from emberscope.llm import fingerprints as fp
from emberscope.llm import lexical_search, spelling
from emberscope.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, n long, row long, term string, word string, part int"


def frame(spark, texts):
    """Texts by id, with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, 7, 8, "t", "w", 9) for i, t in texts], DOC)


def odd_texts():
    long = " ".join(f"word{i % 7919}abcdef" for i in range(60_000))
    return [
        (0, None), (1, ""), (2, " \n\t"), (3, "ash"), (4, "Ash ash fire"), (4, "Ash ash fire"), (5, "ash fire"),
        (6, "fire ash"), (7, long), (8, long), (None, "ash ash"), (None, "ash ash"), (None, None), (9, "ÉTÉ ash 9"),
    ]


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute_search(docs, items, k):
    counts = [Counter(terms(t)) for _, t in docs]
    n_docs, n_terms = sum(map(bool, counts)), sum(sum(c.values()) for c in counts)
    out = {}
    for item, text in items:
        scored = []
        for place, ((doc_id, _), held) in enumerate(zip(docs, counts)):
            score = 0
            for t in set(terms(text)) & set(held):
                df = sum(t in c for c in counts)
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                m = 100 - 50 + (50 * sum(held.values()) * n_docs) // n_terms
                score += w * ((1000000000 * held[t]) // (1000 * held[t] + 20 * m))
            if score:
                scored.append((-score, doc_id is None, doc_id or 0))
        out[item] = [(r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k])]
    return out


def found(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r["item_id"]].append((r["rank"], r["doc_id"], r["score"]))
    return {item: sorted(rows) for item, rows in out.items()}


@pytest.mark.parametrize("block, step", [(16_384, 64), (3, 1)])
def test_search_equals_brute_force(spark, monkeypatch, block, step):
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", block)
    monkeypatch.setattr(lexical_search, "FIRST_READ", step)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choices(words, weights=range(60, 0, -1), k=rng.randint(1, 40)))) for i in range(150)]
    docs += odd_texts()
    items = [(i, " ".join(rng.sample(words, rng.randint(1, 25)))) for i in range(12)] + [(50, "ash fire ÉTÉ"), (51, "")]
    items += [(52, None), (53, "nowhere else"), (54, " ".join(f"word{i}abcdef" for i in range(500)))]
    want = {item: rows for item, rows in brute_search(docs, items, 10).items() if rows}
    queries = spark.createDataFrame(items, "item_id long, text string")
    assert found(lexical_search.search(frame(spark, docs), queries, k=10)) == want
    monkeypatch.setattr(lexical_search, "QUERY_TERMS_MAX", 20)
    monkeypatch.setattr(lexical_search, "VOCABULARY_MAX", 20)
    assert found(lexical_search.search(frame(spark, docs), queries, k=10)) == want


def test_lists_are_left_unread():
    """Reading stops above the end of the lists once the order is settled."""
    class Counted(np.ndarray):
        read = 0

        def __getitem__(self, key):
            if isinstance(key, slice):
                Counted.read += len(range(*key.indices(len(self))))
            return super().__getitem__(key)

    size = 100_000
    places = np.arange(size)
    adds = np.sort(np.random.default_rng(1).integers(1, 1000, size))[::-1].copy()
    adds[:10] = np.arange(10_000_010, 10_000_000, -1)
    lists = [(places.view(Counted), adds), (places.view(Counted), adds)]
    got, scores = lexical_search.read_lists(lists, size, 10, 0)
    assert sorted(got.tolist()) == list(range(10)) and sorted(scores.tolist()) == sorted(2 * adds[:10])
    assert Counted.read < size // 100


def test_search_on_empty_tables(spark):
    none = frame(spark, [])
    queries = spark.createDataFrame([(1, "ash")], "item_id long, text string")
    assert lexical_search.search(none, queries).count() == 0
    assert lexical_search.search(frame(spark, odd_texts()), queries.limit(0)).count() == 0


def brute_variants(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    form = {}
    neighbours = {}
    for w, n in words.items():
        close = [v for v in words if near(w, v)]
        neighbours[w] = len(close)
        best = min(close, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 5 * n else None
    rows = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, words[w], neighbours[w], words.get(form[w])))
    return rows


@pytest.mark.parametrize("filter_bytes", [64 << 20, 16])
def test_variants_equal_brute_force(spark, monkeypatch, filter_bytes):
    monkeypatch.setattr(spelling, "FILTER_BYTES", filter_bytes)
    rng = random.Random(3)
    base = ["flamme", "aabbcc", "aabbc", "éclairs", "burning", "ashfall", "Ünderbrush", "zzzzzzz"]

    def variant(w):
        i = rng.randrange(len(w) + 1)
        return rng.choice([w, w, w, w[:i] + w[i + 1 :], w[:i] + "ae"[rng.randrange(2)] + w[i:], w[:i] + "é" + w[i + 1 :]])

    docs = [(i, " ".join(variant(variant(rng.choice(base))) for _ in range(60))) for i in range(120)] + odd_texts()
    docs += [(1000 + i, "flammes " * 40 + "x" * 300) for i in range(6)]
    got = spelling.group_variants(frame(spark, docs)).select("word", "form", "root", "n", "n_near", "form_n")
    got = [tuple(r) for r in got.collect()]
    want = brute_variants(docs)
    assert len(got) == len(want) and set(got) == want
    assert sum(r[1] is not None for r in want) > 10


def test_variants_on_empty_tables(spark):
    assert spelling.group_variants(frame(spark, [])).count() == 0
    assert spelling.group_variants(frame(spark, [(1, None), (2, "short words")])).count() == 0


def test_filter_admits_every_key_and_few_others():
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 1 << 64, 20_000, np.uint64)
    blocks = len(keys) * spelling.BITS_PER_WORD // 512
    bits = spelling.set_bits(keys, spelling._block(keys, blocks), blocks)
    assert len(spelling.admitted(bits, keys)) == len(keys)
    others = rng.integers(0, 1 << 64, 100_000, np.uint64)
    assert len(spelling.admitted(bits, others)) < 1000


def hash_by_hand(text, base):
    return sum((ord(c) + 1) * pow(base, i, fp.PRIME) for i, c in enumerate(text)) % fp.PRIME


def test_prefix_hashes_answer_spans_and_extensions(monkeypatch):
    for block in (fp.BLOCK, 16):
        monkeypatch.setattr(fp, "BLOCK", block)
        fp._powers.cache_clear()
        rng = random.Random(block)
        a = "".join(rng.choices("abcé𝄞", k=300))
        b = "xyz" + a[20:180] + "q" + a[181:]
        ha, hb = fp.PrefixHashes(fp.code_points(a)), fp.PrefixHashes(fp.code_points(b))
        for _ in range(40):
            i, j = sorted(rng.sample(range(301), 2))
            want = hash_by_hand(a[i:j], fp.BASES[0]) << 31 | hash_by_hand(a[i:j], fp.BASES[1])
            assert ha.span(i, j) == want
        assert ha.spans(7).tolist() == [hash_by_hand(a[i : i + 7], fp.BASES[0]) for i in range(294)]
        for i, j in ((20, 3), (60, 43), (181, 164), (0, 0), (300, 10)):
            want = next((k for k in range(min(300 - i, len(b) - j)) if a[i + k] != b[j + k]), min(300 - i, len(b) - j))
            assert fp.common_extension(ha, i, hb, j) == want
    fp._powers.cache_clear()


def test_likeness():
    rng = random.Random(4)
    text = "".join(rng.choices("abcdefgh ", k=5000))
    other = "".join(rng.choices("abcdefgh ", k=5000))
    mark = fp.fingerprint_of
    assert fp.likeness(mark(text), mark(text)) == 1.0
    assert fp.likeness(mark(text), mark(other)) < 0.1
    assert 0.4 < fp.likeness(mark(text), mark(text[:2500] + other[:2500])) < 0.8
    assert fp.likeness(mark(text), mark(text[:100] + "#" + text[101:3000] + "#" + text[3001:])) > 0.7
    assert fp.likeness(mark(text), mark(text + "#")) > 0.9
    assert fp.likeness(mark(""), mark("")) == 1.0 and fp.likeness(mark(""), mark("a")) == 0.0
    assert 0.0 <= fp.likeness(mark("a"), mark("abc")) <= 1.0


def check_fingerprints(rows, docs):
    texts = defaultdict(list)
    for doc_id, text in docs:
        texts[doc_id].append(text or "")
    assert Counter(r["doc_id"] for r in rows) == {i: len(t) for i, t in texts.items()}
    ids = sorted((i for i in texts if i is not None), reverse=True)
    first = {r["doc_id"]: r for r in rows if len(texts[r["doc_id"]]) == 1}
    for i, follow in zip(ids, [*ids[1:], None if None in texts else ids[0]]):
        if len(texts[i]) > 1 or follow is None or len(set(texts[follow])) > 1:
            continue
        text, after, r = texts[i][0], texts[follow][0], first[i]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == fp.fingerprint_of(text)
        assert r["edited_fingerprint"] == fp.fingerprint_of(edited)
        assert r["near_edited"] == fp.likeness(r["fingerprint"], r["edited_fingerprint"])
        assert r["near_next"] == fp.likeness(r["fingerprint"], fp.fingerprint_of(after))


def test_fingerprints_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = QUERIES["op13_fingerprints"](spark, SF_DIR).collect()
    check_fingerprints(rows, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert 0.3 < sum(r["near_edited"] for r in rows) / len(rows) < 0.8


def test_fingerprints_of_odd_rows(spark):
    docs = odd_texts()
    check_fingerprints(fp.fingerprint_documents(frame(spark, docs)).collect(), docs)
    assert fp.fingerprint_documents(frame(spark, [])).count() == 0
    one = fp.fingerprint_documents(frame(spark, [(3, "ash and fire")])).collect()
    check_fingerprints(one, [(3, "ash and fire")])
    assert one[0]["near_next"] == 1.0


def test_rows_keep_their_place_however_a_scan_is_split(spark, tmp_path, monkeypatch):
    """Marks are made under one split of the scan and applied under another."""
    import corpus_pipeline
    from pyspark.sql import functions as F

    from emberscope.llm import exact_dedup, line_dedup, secret_scan, storage

    passage = "\n".join(f"line {i} of a passage that is long enough to be met again" for i in range(6))
    texts = [f"text {i % 400} " + ("token = abcdef0123 " if i % 7 == 0 else "") for i in range(1000)]
    rows = [(i, t + (passage if i % 50 == 0 else ""), 1, 77) for i, t in enumerate(texts)]
    path = str(tmp_path / "docs")
    given = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, _row int")
    given.withColumn("__row", F.lit(88)).repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    split = "spark.sql.leafNodeDefaultParallelism"
    real = storage.stored

    def then_split(df, label):
        out = real(df, label)
        spark.conf.set(split, "7" if spark.conf.get(split) == "1" else "1")
        return out

    spark.conf.set(split, "1")
    try:
        for module in (corpus_pipeline, exact_dedup, line_dedup, secret_scan):
            monkeypatch.setattr(module, "stored", then_split)
        left = {r["text"]: r["doc_id"] for r in corpus_pipeline.exact_duplicates(spark, docs, "").collect()}
        first: dict = {}
        for i, t, *_ in rows:
            first.setdefault(t, i)
        assert left == first
        masked = corpus_pipeline.secret_scan(spark, docs, "").collect()
        assert len(masked) == 1000 and not any("abcdef0123" in r["text"] for r in masked)
        assert {(r["_row"], r["__row"]) for r in masked} == {(77, 88)}
        cut = line_dedup.drop_repeated_lines(docs).collect()
        assert [r["doc_id"] for r in cut if "line 5 of" in r["text"]] == [0]
        assert {(r["_row"], r["__row"]) for r in cut} == {(77, 88)} and len(cut) == 1000
    finally:
        spark.conf.unset(split)
