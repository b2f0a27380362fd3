"""Operators for training text: brute force, round trips and odd rows."""

import hashlib
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle_check import compare, connect

from emberscope.llm import bpe, chat, exact_dedup, jaccard_join, licences, line_dedup, packing, quality, secret_scan, token_files
from emberscope.llm.components import components
from emberscope.llm.oracles import ORACLES
from emberscope.llm.pretokens import library_encoder
from emberscope.llm.queries import QUERIES, vocabulary

SF_DIR = "/root/testdata/sf0.001"
WORD, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"
DOC = "doc_id long, text string, lang string, source string, n_chars long, kept string, id string, n string"


def tokenizer(name):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(vocabulary(name))
    tok.no_truncation()
    tok.no_padding()
    return tok


def odd_docs(spark):
    """Nulls everywhere, empty and very long texts, ties, repeated rows, clashing extra columns."""
    long = " ".join(f"word{i % 7919}" for i in range(40_000))
    texts = [None, "", " \n\t", "one", "a b c d", "a b c d", "A  B\nc d", long, long, "token = \"abcdef0123\" x" * 3]
    rows = [(i, t, "en", "s", 1, "k", "i", "n") for i, t in enumerate(texts)]
    rows += [rows[4], (None, "a b c d", None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOC)


def empty_docs(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", [WORD, BYTE])
def test_batch_encoding_matches_library(name):
    random.seed(3)
    bits = ["'", "s", "ll", "re", " ", "  ", "\n", "1", "２", "é", "Σ", "İ", "!", "漢", "　", "a", "<|endoftext|>", "_", "²"]
    texts = ["".join(random.choices(bits, k=random.randint(0, 12))) for _ in range(3000)]
    tok = tokenizer(name)
    ids, counts = library_encoder(vocabulary(name)).encode(texts)
    own, at = [], 0
    for n in counts.tolist():
        own.append(ids[at : at + n].tolist())
        at += n
    assert own == [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    model = bpe.Bpe(open(vocabulary(name), encoding="utf-8").read())
    ids, counts = model.encoder().encode(texts)
    assert ids.tolist() == [i for x in own for i in x]
    assert [model.decode(x) for x in own] == [tok.decode(x, skip_special_tokens=False) for x in own]


def test_bpe_query(spark, docs):
    tok = tokenizer(WORD)
    got = {r.doc_id: r for r in QUERIES["op5_bpe"](spark, SF_DIR).collect()}
    for r in docs.collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        text = tok.decode(ids, skip_special_tokens=False)
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(raw).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_odd_rows(spark):
    out = bpe.encode(odd_docs(spark), vocabulary(WORD), ("ids", "decoded"))
    assert out.count() == 13
    assert out.filter("doc_id = 1").first().ids == []
    assert bpe.encode(empty_docs(spark), vocabulary(WORD)).count() == 0
    back = bpe.decode(out, vocabulary(WORD)).withColumnRenamed("decoded", "again")
    assert out.filter("doc_id is not null").join(back, "doc_id").filter("again != decoded").count() == 0


def _check_packing(rows, docs, capacity, tok, end_id):
    pieces, places = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    for r in docs:
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [end_id]
        own = sorted(pieces[r.doc_id], key=lambda x: x.piece)
        assert [(x.start, x.length) for x in own] == [(k, min(capacity, len(ids) - k)) for k in range(0, len(ids), capacity)]
        for x in own:
            part = b"".join(i.to_bytes(4, "little") for i in ids[x.start : x.start + x.length])
            assert x.ids_crc32 == zlib.crc32(part)
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_packing_query(spark, docs):
    rows = QUERIES["op3_best_fit_packing"](spark, SF_DIR).collect()
    n = _check_packing(rows, docs.collect(), 2048, tokenizer(WORD), 0)
    assert n <= -(-sum(r.length for r in rows) // 2048) + 2


def test_packing_hot_length_and_empty(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", 7)
    rows = [(i, "one two three" if i % 3 else f"word{i} " * (i % 9), "en", "s", 1, "", "", "") for i in range(300)]
    some = spark.createDataFrame(rows, DOC)
    out = packing.pack_documents(some, vocabulary(WORD), 16, 0).collect()
    _check_packing(out, some.collect(), 16, tokenizer(WORD), 0)
    assert packing.pack_documents(empty_docs(spark), vocabulary(WORD), 16).count() == 0
    assert packing.pack_documents(odd_docs(spark), vocabulary(WORD), 16).filter("doc_id is null").count() == 2


def test_fullest_is_optimal():
    random.seed(5)
    for _ in range(200):
        lengths = Counter(random.randint(1, 12) for _ in range(random.randint(1, 8)))
        room = random.randint(1, 30)
        sums = {0}
        for k, n in lengths.items():
            for _ in range(n):
                sums |= {s + k for s in sums if s + k <= room}
        chosen = packing.fullest(sorted(lengths.items(), reverse=True), room)
        assert all(chosen[k] <= lengths[k] for k in chosen)
        assert sum(k * n for k, n in chosen.items()) == max(sums)


def test_token_files(spark, docs, tmp_path):
    tok, at = tokenizer(BYTE), 0
    got = {r.doc_id: r for r in QUERIES["op10_token_files"](spark, SF_DIR).collect()}
    for r in docs.orderBy("doc_id").collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [2]
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert tuple(got[r.doc_id]) == (r.doc_id, at, len(ids), zlib.crc32(raw))
        at += len(ids)


def test_token_files_look_up_and_odd_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 50)
    path = str(tmp_path / "files")
    token_files.write_token_files(odd_docs(spark), path, vocabulary(BYTE))
    assert token_files.read_documents(spark, path).count() == 13
    some = odd_docs(spark).filter("doc_id is not null")
    path = str(tmp_path / "more")
    token_files.write_token_files(some, path, vocabulary(BYTE))
    asked = spark.createDataFrame([(3,), (4,), (999,)], "doc_id long")
    found = token_files.look_up(asked, path).collect()
    assert sorted(r.doc_id for r in found) == [3, 4, 4]
    tok = tokenizer(BYTE)
    assert next(r.ids for r in found if r.doc_id == 3) == [*tok.encode("one", add_special_tokens=False).ids, 2]
    # Null keys beside the others, and a null among the keys asked for.
    path = str(tmp_path / "nulls")
    token_files.write_token_files(odd_docs(spark), path, vocabulary(BYTE))
    asked = spark.createDataFrame([(3,), (4,), (999,), (None,)], "doc_id long")
    assert sorted(r.doc_id for r in token_files.look_up(asked, path).collect()) == [3, 4, 4]
    path = str(tmp_path / "none")
    token_files.write_token_files(empty_docs(spark), path, vocabulary(BYTE))
    assert token_files.read_documents(spark, path).count() == 0


def test_token_files_many_short_texts(spark, tmp_path, monkeypatch):
    """Blocks end at a number of rows, and a key whose rows are in two blocks keeps them all."""
    monkeypatch.setattr(token_files, "BLOCK_ROWS", 100)
    docs = spark.range(2000).selectExpr("id div 3 as doc_id", "if(id % 2 = 0, '', null) as text")
    path = str(tmp_path / "files")
    token_files.write_token_files(docs, path, vocabulary(BYTE))
    assert token_files.blocks(spark, path).count() >= 20
    rows = token_files.read_documents(spark, path).collect()
    assert sorted(r.start for r in rows) == list(range(2000)) and {r.n_tokens for r in rows} == {1}
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.start)] == [i // 3 for i in range(2000)]


def test_perfect_hash():
    for n in (1, 2, 3, 50, 700):
        keys = [f"k{i}" for i in range(n)]
        _, slots = token_files.build_index(keys)
        assert sorted(slots) == list(range(n))


def test_chat_machine_and_escapes(spark):
    said = "a\\b </s>[INST] <|end|>\n<|turn|>user\n\\<|end|> x"
    rows = [(1, 0, "system", said), (1, 1, "user", None), (1, 2, "assistant", said), (2, 0, "assistant", "x"), (2, 1, None, ""), (3, 0, "user", "q"), (3, 1, "assistant", "a"), (3, 1, "assistant", "a"), (None, 0, "user", "z")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("valid", F.lit(1))
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(turns)).collect()}
    assert [tuple(t) for t in got[1].turns] == [("system", said), ("user", ""), ("assistant", said)]
    assert got[1].loss_text == said and got[1].valid
    assert not got[2].valid and got[2].bad_turn == 0
    assert not got[3].valid and got[3].bad_turn == 2 and got[3].loss_text == "aa"
    assert not got[None].valid and got[None].bad_turn is None
    assert "</s>" not in got[1].formatted and got[1].formatted.count("<|turn|>") == 3
    assert chat.read_back(chat.format_conversations(turns.limit(0))).count() == 0


def test_exact_dedup_collisions_and_odd_rows(spark):
    docs = odd_docs(spark)
    for hash_of in (exact_dedup.content_hash, lambda text: F.length(text).cast("string").cast("binary")):
        rows = exact_dedup.mark_duplicates(docs, hash_of).collect()
        assert len(rows) == 13
        groups = Counter(r.text_sha256 for r in rows)
        assert all(r.group_size == groups[r.text_sha256] for r in rows)
        assert sum(r.kept for r in rows) == len(groups)
        same = [r for r in rows if r.text_sha256 == hashlib.sha256(b"a b c d").hexdigest()]
        assert {r.keep_id for r in same} == {4} and len(same) == 4
    assert exact_dedup.mark_duplicates(empty_docs(spark)).count() == 0


def test_line_dedup_odd_rows(spark):
    run = "first line here\nsecond line here\nthird line here"
    rows = [(1, f"top\n{run}\nend"), (2, f"{run}\n\n{run}"), (3, f"x\n\n{run.replace(chr(10), chr(10) * 2)}\ny"), (None, run), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_lines", F.lit("x"))
    got = {r.doc_id: r for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert got[1].text == rows[0][1] and got[1].n_removed == 0
    assert got[2].text.strip() == "" and got[2].n_removed == 6
    assert got[3].text.split() == ["x", "y"] and got[None].n_removed == 3
    assert got[4].text is None and got[5].n_lines == 0
    assert line_dedup.drop_repeated_lines(docs.limit(0)).count() == 0


def test_line_dedup_long_passages_and_short_documents(spark):
    """One or two lines of more than 50 words, whole documents of one or two lines; boilerplate stays."""
    words = lambda k, n: " ".join(f"{k}{i}" for i in range(n))
    one, a, b, at_bound, note = words("x", 51), words("a", 20), words("b", 31), words("y", 50), "All rights reserved."
    rows = [
        (1, f"top\n{one}\n{a}\n\n{b}\n{at_bound}\n{note}\nend"),
        (2, f"here\n{one}\nthere"), (3, f"this\n{a}\n{b}\nthat"), (4, one), (5, f"p\n{at_bound}\nq\n{note}\nr\n{a}\ns"),
        (6, note), (7, note), (8, f"{note}\n\nTwo."), (9, f"\n{note}\nTwo."), (10, f"{one}\n{one}\nu\nv"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).localCheckpoint()
    got = {r.doc_id: r for r in line_dedup.drop_repeated_lines(docs).collect()}
    left = {i: [x for x in r.text.split("\n") if x] for i, r in got.items()}
    assert [r.n_removed for _, r in sorted(got.items())] == [0, 1, 2, 1, 0, 0, 1, 0, 2, 2]
    assert left[2] == ["here", "there"] and left[3] == ["this", "that"] and left[4] == [] and left[10] == ["u", "v"]
    assert left[6] == [note] and left[7] == left[9] == [] and note in left[5] and at_bound in left[5]


def brute_components(rows):
    sets = {}
    for i, text in rows:
        words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("hot", [1, 4])
def test_jaccard_join_brute_force(spark, monkeypatch, hot):
    """Chains of edits, a passage shared by all, small sets at the bound, and a dense group."""
    monkeypatch.setattr(jaccard_join, "HOT", hot)
    monkeypatch.setattr(jaccard_join, "MEMBERS_TOGETHER", 5)
    random.seed(hot)
    passage = [f"p{i}" for i in range(60)]
    rows, n = [], 0
    for size in (3, 5, 8, 9, 12, 26, 31, 60, 150, 400):
        for _ in range(4):
            base = [f"w{random.randint(0, 10**6)}" for _ in range(size)]
            if random.random() < 0.5:
                base[size // 2 : size // 2] = passage
            for _ in range(6):
                rows.append((n, " ".join(base)))
                n += 1
                for _ in range(random.randint(0, max(1, size // 60))):
                    k = random.randrange(len(base))
                    base[k : k + random.randint(0, 1)] = [f"e{random.randint(0, 10**6)}"]
                if random.random() < 0.3:
                    base = base[: -max(1, size // 9)] if len(base) > 6 else base
    rows += [(n, None), (n + 1, ""), (n + 2, "Same Words"), (n + 3, "same words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link_documents(docs).collect()}
    assert got == brute_components(rows)


def test_jaccard_join_odd_rows(spark):
    out = jaccard_join.link_documents(odd_docs(spark)).collect()
    assert len(out) == 13
    assert sorted((r.doc_id, r.component_id) for r in out if r.n_shingles == 1 and r.doc_id in (4, 5, 6)) == [(4, 4), (4, 4), (5, 4), (6, 4)]
    assert jaccard_join.link_documents(empty_docs(spark)).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 7), (50, 51), (52, 51), (60, 60)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in [*range(41), 100]} == {0} and {got[i] for i in (50, 51, 52)} == {50}


def test_secret_ledger(spark):
    v = lambda rows: spark.createDataFrame(rows, "path long, text string")
    leak = "x password: hunter22 and AKIA" + "A" * 16
    found, ledger, known = secret_scan.scan_versions(v([(1, leak), (2, "clean"), (3, None), (3, leak)]))
    assert {r.path: len(r.spans) for r in found.collect() if r.spans} == {1: 2, 3: 2} and ledger.count() == 3
    found, ledger, again = secret_scan.scan_versions(v([(4, leak), (5, "token=abcdefg")]), ledger, known)
    assert {r.path: len(r.spans) for r in found.collect()} == {4: 2, 5: 1}
    assert again.count() == 2 and ledger.count() == 4
    text = spark.createDataFrame([(leak,)], "text string").crossJoin(known.select("spans"))
    assert text.select(secret_scan.masked(F.col("text"), F.col("spans"))).first()[0] == "x [SECRET] and [SECRET]"
    assert secret_scan.scan_versions(v([]))[0].count() == 0


def test_quality_counts_and_outliers(spark):
    random.seed(2)
    rows = [(i, " ".join(f"{random.choice('abcdef')}w{random.randint(0, 999)}" for _ in range(random.randint(60, 300))), "en", "s", 1, "", "", "") for i in range(200)]
    rows += [(900, "$$$ ### %%% " + " ".join(f"*{i}*" for i in range(90)), "en", "s", 1, "", "", ""), (901, "a b c " * 40, "en", "s", 1, "", "", "")]
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, DOC)).collect()}
    assert not got[900].kept and not got[900].base_failed and got[901].base_failed
    assert sum(got[i].kept for i in range(200)) == 200
    for i, text, *_ in rows:
        words = text.split()
        grams = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        hit = {k + j for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for j in range(3)}
        assert (got[i].n_words, got[i].word_chars, got[i].n_repeat_words) == (len(words), sum(map(len, words)), len(hit))
        assert got[i].n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert got[i].n_dup_lines == 0
    odd = quality.judge(odd_docs(spark))
    assert odd.count() == 13 and odd.filter("kept and base_failed").count() == 0
    assert quality.judge(empty_docs(spark)).count() == 0


def numpy_kept(rows):
    """Robust estimates by group, else language, else all; rows are judged rows with ``lang`` and ``source``."""
    import numpy as np

    floors, d = np.array([f for _, f in quality.VECTOR.values()]), len(quality.VECTOR)
    bound = quality.chi2_quantile(1 - 1 / quality.ONE_IN, d)
    scale = quality.KEPT_SHARE / quality._chi2_cdf(quality.chi2_quantile(quality.KEPT_SHARE, d), d + 2)
    within = [r for r in rows if not r.base_failed]
    x = {
        r.doc_id: np.array([
            np.log(1 + r.n_words), np.log(r.word_chars / r.n_words), np.log(1 + 10 * r.n_symbols / r.n_words),
            r.n_dup_lines / r.n_lines, r.n_repeat_words / r.n_words,
        ])
        for r in within
    }
    bins = lambda v, p: np.quantile(np.floor(v * quality.VALUE_BINS), p, axis=0)
    middle = lambda v: (bins(v, 0.5) + 0.5) / quality.VALUE_BINS

    def far(v, m, cov):
        return np.einsum("ij,jk,ik->i", v - m, np.linalg.inv(cov + np.diag(floors**2)), v - m)

    def starts(v):
        m, s = middle(v), (bins(v, 0.75) - bins(v, 0.25)) / quality.VALUE_BINS / 1.349
        r = np.cov(np.tanh((v - m) / np.maximum(s, floors)).T, bias=True)
        spread = np.sqrt(np.outer(np.diag(r), np.diag(r)))
        r = np.divide(r, spread, out=np.zeros_like(r), where=spread > 0)
        np.fill_diagonal(r, 1)
        return [(m, np.diag(s**2)), (v.mean(axis=0), np.cov(v.T, bias=True)), (m, r * np.outer(s, s))]

    def estimate(v):
        tried = []
        for m, cov in starts(v):
            before = np.inf
            while True:
                dist = np.floor(np.log(np.maximum(far(v, m, cov), 1e-9)) * quality.DISTANCE_BINS)
                core = v[dist <= np.quantile(dist, quality.KEPT_SHARE)]
                m, cov = core.mean(axis=0), np.cov(core.T, bias=True) * scale
                det = np.linalg.slogdet(cov + np.diag(floors**2))[1]
                tried.append((det, m, cov))
                if det >= before - quality.FALL:
                    break
                before = det
        return min(tried, key=lambda t: t[0])[1:]

    kept = {r.doc_id: False for r in rows}
    usual = {k: middle(np.array([x[r.doc_id][1] for r in within if r.lang == k])) for k in {r.lang for r in within}}
    shift = lambda k: np.array([0, usual[k], 0, 0, 0])
    for r in within:
        group = [x[o.doc_id] for o in within if (o.lang, o.source) == (r.lang, r.source)]
        language = [x[o.doc_id] for o in within if o.lang == r.lang]
        v = x[r.doc_id]
        if max(len(group), len(language)) >= quality.MIN_GROUP:
            m, cov = estimate(np.array(group if len(group) >= quality.MIN_GROUP else language))
        else:
            m, cov = estimate(np.array([x[o.doc_id] - shift(o.lang) for o in within]))
            v = v - shift(r.lang)
        kept[r.doc_id] = bool(far(v[None], m, cov)[0] <= bound)
    return kept


def test_quality_judges_small_groups(spark):
    """A large group, small ones of a large language, and a small language with longer words."""
    random.seed(7)
    rows = []

    def add(n, lang, source, junk=0, tail=""):
        for k in range(n):
            text = " ".join(f"{random.choice('abcdef')}w{random.randint(0, 999)}{tail}" for _ in range(random.randint(60, 300)))
            text = text + " $$$ ###" * 3 if k >= junk else " ".join(f"*#{i}*$ {i}" for i in range(random.randint(80, 120)))
            rows.append((len(rows), text, lang, source, 1, "junk" if k < junk else "fine", "", ""))

    add(90, "en", "a", 3)
    for s in "abc":
        add(24, "es", s, 2)
    add(9, "xx", "a", 1, "longwords" * 2)
    add(1, None, None)
    docs = spark.createDataFrame(rows, DOC)
    judged = quality.judge(docs).join(docs.select("doc_id", "lang", "source"), "doc_id").collect()
    got = {r.doc_id: r.kept for r in judged}
    assert got == numpy_kept(judged)
    assert all(got[r[0]] == (r[5] == "fine") for r in rows)


def test_quality_query(spark, docs):
    """The registered query against counts by Python and estimates by numpy."""
    from emberscope.llm.queries import op9_quality_rules

    texts = {r.doc_id: r for r in docs.collect()}
    judged = quality.judge(docs).collect()
    got = {r.doc_id: r for r in op9_quality_rules(spark, SF_DIR).collect()}
    assert got.keys() == texts.keys()
    assert {i: r.kept for i, r in got.items()} == numpy_kept(judged)
    for i, r in got.items():
        lines = [x for x in (texts[i].text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert r.n_dup_lines == len(lines) - len(set(lines))


def test_quality_few_documents(spark):
    assert quality.distance_bound(6, 5) == float("inf") and 60 < quality.distance_bound(49, 5) < quality.distance_bound(30, 5)
    assert abs(quality._f_tail(3.3258, 5, 10) - 0.05) < 1e-4
    rows = [(i, " ".join(f"{random.choice('abcdef')}w{random.randint(0, 999)}" for _ in range(60 + 5 * i)), "en", "s", 1, "", "", "") for i in range(40)]
    rows.append((900, " ".join(f"*#{i}*$ {i}" for i in range(90)), "en", "s", 1, "", "", ""))
    got = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame(rows, DOC)).collect()}
    assert got == {i: i != 900 for i in got}


def test_chi2_quantile():
    assert abs(quality.chi2_quantile(0.95, 5) - 11.0705) < 1e-3


def test_licences(spark):
    full = "MIT Licence\n\nCopyright (c) 2020 Somebody\n\nPermission is granted."
    known = spark.createDataFrame([("X", "mit license permission is granted"), ("Y", "Other")], "licence_id string, text string")
    docs = spark.createDataFrame([(1, full), (2, "a\n\nOther!\n\nb"), (3, None), (4, ""), (2, "x")], "doc_id long, text string")
    got = [(r.doc_id, r.licences, r.levels) for r in licences.scan(docs.withColumn("level", F.lit(1)), known).collect()]
    assert sorted(got) == [(1, ["X"], ["document"]), (2, [], []), (2, ["Y"], ["line", "paragraph"]), (3, [], []), (4, [], [])]
    assert licences.scan(docs.limit(0), known).count() == 0


def test_licence_query_knows_full_texts(spark, tmp_path):
    folder = os.path.join(os.path.dirname(licences.__file__), "licence_texts")
    read = lambda name: open(os.path.join(folder, name), encoding="utf-8").read()
    header = read("Apache-2.0/header.txt").replace("\n", "\n# ")
    rows = [
        (1, "MIT Licence\n\nCopyright (c) 2020 A. Body\n\n" + read("MIT/text.txt").upper()), (2, "# Copyright 2021 B\n#\n# " + header),
        (3, read("GPL-3.0-only/text.txt")), (4, "Copyright (c) 2019, C.\n" + read("BSD-2-Clause/reserved.txt")),
        (5, read("MIT/text.txt") + "\nand more"), (6, "Released under the MIT License."),
    ]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.licences for r in QUERIES["op1_licence_scan"](spark, str(tmp_path)).collect()}
    assert got == {1: "MIT", 2: "Apache-2.0", 3: "GPL-3.0-only", 4: "BSD-2-Clause", 5: "", 6: "MIT"}


def test_pipeline(spark):
    import corpus_pipeline as cp

    rows = cp.run(spark, SF_DIR).collect()
    assert len({r.doc_id for r in rows}) <= 200
    raw = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = cp.near_duplicates(spark, cp.exact_duplicates(spark, cp.quality_rules(spark, raw, SF_DIR), SF_DIR), SF_DIR)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows} and kept.columns == raw.columns
    for docs in (odd_docs(spark), empty_docs(spark)):
        for _, stage in cp.STAGES[:-1]:
            out = stage(spark, docs, SF_DIR)
            assert out.columns == docs.columns
            out.count()
    masked = cp.secret_scan(spark, odd_docs(spark), SF_DIR).filter("doc_id = 9").first()
    assert "abcdef0123" not in masked.text and masked.n_chars == len(masked.text)


def test_new_words_of_a_byte_vocabulary_are_encoded_in_one_go():
    import numpy as np

    encoder = library_encoder(vocabulary("byte_bpe_50k.json"))
    found = ["the", " quick", " ", "\n\n", "\x00", "é", " 中文", "🔥", "\t", "a" * 500, "'s", " 12345", "﷽", "퟿"]
    each = [encoder.whole(w) for w in found]
    got = encoder.encode_words(found)
    assert all(isinstance(b, bytes) for b in got)
    assert [np.frombuffer(b, np.uint32).tolist() for b in got] == each


def test_pilots_are_tried_side_by_side(monkeypatch):
    """A key costs no Python call for each pilot tried; each bucket takes its first pilot that fits."""
    from emberscope.llm import token_files

    calls, mix = [], token_files._mix
    monkeypatch.setattr(token_files, "_mix", lambda x: calls.append(x) or mix(x))
    for n in (1, 2, 5, 700):
        keys = [f"key {i}" for i in range(n)]
        pilots, slots = token_files.build_index(keys)
        assert not calls and sorted(slots) == list(range(n))
        hashes = [token_files._hash(k) for k in keys]
        buckets = [h % len(pilots) for h in hashes]
        taken = set()
        for b in sorted(range(len(pilots)), key=lambda b: -buckets.count(b)):
            own = [i for i in range(n) if buckets[i] == b]
            for pilot in range(pilots[b] + 1):
                at = [token_files._slot(hashes[i], pilot, n) for i in own]
                assert (len({*at}) == len(at) and not taken & {*at}) == (pilot == pilots[b])
            assert at == [slots[i] for i in own]
            taken |= {*at}
        calls.clear()
