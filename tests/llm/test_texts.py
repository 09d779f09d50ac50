"""Operators on texts against brute force, on a small fixture with nulls, empty and long texts, copies and clashing column names."""
import hashlib
import itertools
import random
import re
import time
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from mendstream.llm import bpe, chat, fingerprint, mixing, ngramjoin, suffix

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = " ".join(f"word{i * 7919 % 997}" for i in range(120))
PASSAGE = "A passage that several documents share, " * 3 + " ".join(str(i * i) for i in range(60))
TEXTS = [
    BASE, BASE, BASE.replace("word0 ", "changed "), BASE + " and more", PASSAGE, "start " + PASSAGE + " end é", "ü" + PASSAGE + PASSAGE,
    None, None, "", "   \t\n", "one", "one", "One two", "ab" * 300, "x" * 700, "Ünï çødé 漢字 🙂 don't <|endoftext|> 12 345\n\n  x", "long " * 20000,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", [None, "a", "b"][i % 3], len(t or ""), "clash", "clash") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, words string, node string").repartition(3).cache()


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def test_bpe_equals_the_tokenizers_library(docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(str(bpe.default_vocabulary()))
    tok.no_truncation()
    tok.no_padding()
    got = {r.doc_id: r for r in bpe.round_trip(docs, bpe.default_vocabulary(), keep=["doc_id"]).collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        ids = tok.encode(t or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == sha(",".join(map(str, ids)))
        assert got[i].decoded_sha256 == sha(tok.decode(ids, skip_special_tokens=False))


def test_bpe_encode_then_decode(docs):
    v = bpe.default_vocabulary()
    back = bpe.decode(bpe.encode(docs, v), v).select("doc_id", "decoded").collect()
    assert {r.doc_id: r.decoded for r in back} == {i: t or "" for i, t in enumerate(TEXTS)}


def test_fingerprints(docs):
    rows = {r.doc_id: r for r in fingerprint.fingerprints(docs).collect()}
    ids = sorted(rows, reverse=True)
    assert len(ids) == len(TEXTS)
    seen = {}
    for k, i in enumerate(ids):
        text, other = TEXTS[i] or "", TEXTS[ids[(k + 1) % len(ids)]] or ""
        n = len(text)
        assert rows[i].n_chars == n
        assert rows[i].edited_sha256 == sha(text[: n - n // 2] + other[: n // 2])
        assert 0 <= rows[i].near_edited <= 1 and 0 <= rows[i].near_next <= 1
        assert seen.setdefault(text, rows[i].fingerprint) == rows[i].fingerprint
    assert rows[1].near_next == 1.0  # its copy follows


def coin(before, sym):
    d = before ^ sym
    low = (d & -d).bit_length() - 1 if d else 0
    return 2 * low + (sym >> low & 1) if d else 0


def plain_fingerprint(text):
    """The phrases of one text, level by level, with plain integers."""
    mod = 1 << 64
    spread = lambda x: int(fingerprint.mix(np.array([x % mod], np.uint64))[0])
    sym, out = [ord(c) for c in text], []
    for level, bins in enumerate(fingerprint.BINS):
        folded = [(k, len(list(g))) for k, g in itertools.groupby(sym)]
        sym = [s if run == 1 else spread(s * 3 + run) for s, run in folded]
        label = [sym[i] & 1 if i == 0 else coin(sym[i - 1], sym[i]) for i in range(len(sym))]
        for _ in range(2):
            label = [label[i] & 1 if i == 0 else coin(label[i - 1], label[i]) for i in range(len(label))]
        begin = [i == 0 or 1 < i < len(sym) - 1 and label[i - 1] < label[i] >= label[i + 1] for i in range(len(sym))]
        at = [i for i, b in enumerate(begin) if b] + [len(sym)]
        sym = [spread(sum(spread(s + k * 0x9E3779B97F4A7C15) for k, s in enumerate(sym[i:j])) + level) for i, j in zip(at, at[1:])]
        found = [0] * bins
        for s in sym:
            h = spread(s ^ (0xA5A5A5A5 + level))
            b, v = (h >> 32) % bins, max(h % (1 << 32), 1)
            found[b] = min(found[b] or v, v)
        out += found
    return out


def test_fingerprints_equal_the_plain_parse(docs):
    rows = {r.doc_id: r for r in fingerprint.fingerprints(docs).collect()}
    ids = sorted(rows, reverse=True)
    for k, i in enumerate(ids):
        text, other = TEXTS[i] or "", TEXTS[ids[(k + 1) % len(ids)]] or ""
        n = len(text)
        own, edited, after = map(plain_fingerprint, (text, text[: n - n // 2] + other[: n // 2], other))
        assert (rows[i].fingerprint, rows[i].edited_fingerprint) == tuple("".join(f"{v:08x}" for v in f) for f in (own, edited))
        for got, b in ((rows[i].near_edited, edited), (rows[i].near_next, after)):
            filled = [(x, y) for x, y in zip(own, b) if x or y]
            assert got == pytest.approx(sum(x == y for x, y in filled) / len(filled) if filled else 1.0)


def test_likeness_at_any_length():
    rng = random.Random(3)
    for n in (2000, 50_000, 1_000_000):
        a, b = ("".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n)) for _ in range(2))
        s = fingerprint.sketches([a, b, a[: n // 2] + b[: n // 2], a[: n * 9 // 10] + b[: n // 10], "some words before it " + a], fingerprint._toss())
        other, half, most, moved = fingerprint.likeness(s[[0] * 4], s[1:])
        assert other < 0.1 and 0.2 < half < 0.6 and most > 0.7 and moved > 0.9


@pytest.mark.parametrize("together", [4096, 1])
def test_repeats_equal_brute_force(docs, together, monkeypatch):
    monkeypatch.setattr(suffix, "TOGETHER", together)  # with 1 every trigger of several phrases goes by rows
    length = 200
    data = [(t or "").encode() for t in TEXTS]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    got = {r.doc_id: r for r in suffix.remove_repeats(docs, length=length).collect()}
    assert len(got) == len(TEXTS)
    for k, d in enumerate(data):
        mark = bytearray(len(d) + 1)
        end = 0
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                for j in range(max(i, end), i + length):
                    mark[j] = 1
                end = i + length
        runs = sum(mark[j] and not (j and mark[j - 1]) for j in range(len(d)))
        kept = bytes(b for b, m in zip(d, mark) if not m)
        assert (got[k]._n_bytes, got[k]._n_removed, got[k]._n_spans) == (len(d), sum(mark), runs)
        assert got[k]._kept_sha256 == sha(kept) and bytes(got[k]._kept) == kept
        assert got[k].words == "clash"


def shingles(text, n):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return ({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or {tuple(w)}) if w else set()


@pytest.mark.parametrize("words,num", [(3, 90), (5, 80)])
def test_components_equal_all_pairs(docs, words, num):
    sets = [shingles(t, words) for t in TEXTS]
    low = list(range(len(TEXTS)))
    links = Counter()
    pairs = [(i, j) for i, j in combinations(range(len(sets)), 2) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])]
    for i, j in pairs:
        links.update((i, j))
    for _ in pairs:
        for i, j in pairs:
            low[i] = low[j] = min(low[i], low[j])
    got = {r._id: r for r in ngramjoin.jaccard_components(docs, words=words, num=num).collect()}
    assert [(got[i].n_shingles, got[i].component_id, got[i].n_links) for i in range(len(TEXTS))] == [(len(s), low[i], links[i]) for i, s in enumerate(sets)]
    kept = ngramjoin.keep_one(docs, words=words, num=num)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(len(TEXTS)) if low[i] == i]


def test_mix_meets_targets(docs):
    mix, sized = mixing.mix_blocks(docs, words=8)
    rows = sized.collect()
    size = [len(WORD.findall(t or "")) for t in TEXTS]
    source = [[None, "a", "b"][i % 3] for i in range(len(TEXTS))]
    total = {s: sum(n for n, x in zip(size, source) if x == s) for s in set(source)}
    weight = {"a": 3, "b": 1, None: 2}
    goal, live, left = {}, set(total), 1.5 * sum(size)
    while live:
        over = [s for s in live if left * weight[s] / sum(weight[x] for x in live) > 2 * total[s]]
        if not over:
            goal |= {s: left * weight[s] / sum(weight[x] for x in live) for s in live}
            break
        goal |= {s: 2 * total[s] for s in over}
        live -= set(over)
        left = 1.5 * sum(size) - sum(goal.values())
    taken = Counter()
    for r in rows:
        assert r.size == size[r._id] and r.source_size == total[source[r._id]] and r.taken <= 2 * r.size
        assert r.target == pytest.approx(goal[source[r._id]])
        taken[source[r._id]] += r.taken
    assert len(rows) == len(TEXTS)
    assert all(abs(taken[s] - goal[s]) <= 8 for s in goal)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_blocks(docs, words=8)[1].collect()))
    drawn, of_row = mix.collect(), Counter()
    assert len({(r.shard, r.place) for r in drawn}) == len(drawn)
    assert {r.shard for r in drawn} <= set(range(64))
    for r in drawn:
        of_row[r._row] += r.words
    assert {r._row: r.taken for r in rows if r.taken} == of_row  # what the shards drew, and nothing else
    assert max(Counter((r._row, r.block) for r in drawn).values()) <= 2


def test_mixing_equal_rows_and_clashing_names(spark):
    """Five equal rows are drawn as five; a caller's columns keep their values under any name."""
    same = "three equal words"
    rows = [(1, same, "a", "x", 9)] * 5 + [(i, f"other words {i} " * 3, "b", "y", i) for i in range(2, 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _dh string, _shard long")
    _, docs = mixing.mix_blocks(df, words=1 << 40)
    out = mixing.mix_documents(df)
    assert out.columns == df.columns
    got = Counter(tuple(r) for r in out.collect())
    taken = docs.where("taken > 0").selectExpr("_id", "taken / size as n").groupBy("_id").agg(F.sum("n").alias("n")).collect()
    assert {r._id: r.n for r in taken} == {k[0]: n for k, n in got.items()}
    assert got[rows[0]] <= 10 and set(got) <= set(rows)


def test_long_words_merge_like_short_ones():
    v = bpe.Vocabulary(bpe.Vocabulary.read(bpe.default_vocabulary()))
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeéz ") for _ in range(n)).encode() for n in (900, 40, 1, 700)] + [b"a" * 800, b"ab" * 400]
    before = bpe.merge_rounds(words, v)
    old, bpe.LONG = bpe.LONG, 30
    try:
        after = bpe.merge_rounds(words, v)
    finally:
        bpe.LONG = old
    assert all((x == y).all() for x, y in zip(before, after))
    start = time.perf_counter()
    ids, _ = bpe.merge_rounds(["".join(rng.choice("acgt") for _ in range(10**6)).encode()], v)
    assert b"".join(v.token[i] for i in ids.tolist()).startswith(b"") and time.perf_counter() - start < 30


def test_words_that_a_polynomial_confuses_stay_apart(spark):
    """Each of the two long words is the other with its letters swapped; a polynomial hash modulo 2^64 takes them for one."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    x, y = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    df = spark.createDataFrame([(1, x), (2, y), (3, f"{x} {x} {y}"), (4, f"{y} {x} {y}")], "doc_id long, text string")
    got = ngramjoin.jaccard_components(df, words=3, num=90).collect()
    assert {r._id: r.component_id for r in got} == {1: 1, 2: 2, 3: 3, 4: 4}


@pytest.mark.parametrize("num", [95, 90, 80, 50])
def test_near_sets_have_a_signature_in_common(num):
    import numpy as np

    rng, found = np.random.default_rng(num), 0
    for n in [*range(1, 40), 57, 120, 300] * 3:
        base, sets = rng.integers(0, 1 << 64, n, dtype=np.uint64), []
        for k in range(8):
            cut, more = rng.integers(0, max(2, n * (100 - num) // 100 + 2), 2)
            sets.append(np.unique(np.append(base[cut % n if k % 3 else 0 :], rng.integers(0, 1 << 64, more if k % 2 else 0, dtype=np.uint64))))
        size = np.array([len(x) for x in sets])
        who, sig = ngramjoin.signatures(np.repeat(np.arange(8), size), np.concatenate(sets), size, num, 100)
        for i in range(8):
            for j in range(i):
                a, b = set(sets[i].tolist()), set(sets[j].tolist())
                if a != b and 100 * len(a & b) >= num * len(a | b):
                    found += 1
                    assert set(sig[who == i].tolist()) & set(sig[who == j].tolist()), (n, a, b)
    assert found > 100


def test_unrelated_texts_of_common_words_meet_in_no_cell(spark, monkeypatch):
    """Each shares its rarest words with some others, so prefixes alone would join all of them to one cluster."""
    import numpy as np

    rng, seen, links = np.random.default_rng(3), [], ngramjoin.linked_nodes
    texts = [" ".join(f"w{x}" for x in rng.choice(3000, 100, replace=False)) for _ in range(300)]
    texts += [t + " tail" for t in texts[:5]]
    monkeypatch.setattr(ngramjoin, "linked_nodes", lambda *a: seen.append(links(*a)) or seen[-1])
    got = ngramjoin.jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), words=1, num=90).collect()
    assert {r._id: (r.component_id, r.n_links) for r in got} == {i: (i % 300, int(i % 300 < 5)) for i in range(305)}
    assert seen[0].count() < 40


@pytest.mark.parametrize("nodes,grams", [(1, 1 << 20), (3, 1 << 20), (1024, 90)])
def test_links_do_not_depend_on_blocks(spark, monkeypatch, nodes, grams):
    """Near copies of several sizes in one cluster, cut into blocks some of which are empty or meet nothing in reach."""
    monkeypatch.setattr(ngramjoin, "BLOCK_NODES", nodes)
    monkeypatch.setattr(ngramjoin, "BLOCK_GRAMS", grams)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[i : i + k]) for k in (20, 24, 30, 38, 47, 58) for i in range(3)]
    sets = [set(t.split()) for t in texts]
    near = [[i != j and 10 * len(a & b) >= 8 * len(a | b) for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    low = list(range(len(sets)))
    for _ in sets:
        low = [min([low[i], *(low[j] for j in range(len(sets)) if near[i][j])]) for i in range(len(sets))]
    got = ngramjoin.jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), words=1, num=80).collect()
    assert {r._id: (r.component_id, r.n_links) for r in got} == {i: (low[i], sum(near[i])) for i in range(len(sets))}


def test_split_tree_keeps_quotas():
    import numpy as np

    quota = np.array([5, 0, 1000, 17])
    leaves = mixing.split_tree(quota, 8, 3)
    assert (leaves.sum(axis=1) == quota).all() and (leaves >= 0).all()
    assert leaves.sum(axis=0).max() - leaves.sum(axis=0).min() <= 3


def test_perspectives(spark):
    rows = [("c", 0, "amy", "hi", 1), ("c", 1, "bob", None, 2), ("c", 70, "amy", "bye", 3), ("d", 0, None, "alone", 4), (None, None, "eve", "x", 5), (None, None, "eve", "x", 6)]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string, speaker int")
    out = chat.perspectives(df).collect()
    assert len(out) == 2 * 3 + 1 + 2
    whole = {}
    for r in sorted(out, key=lambda r: r.seq):
        key = (r.conv_id, r.speaker)
        before = whole.get(key, "")
        assert r.start == len(before)
        whole[key] = before + r.segment
        assert r.end == len(whole[key])
        assert r.train == (r.role == "assistant") and (r.name is None) == r.train
        assert whole[key][r.mask_start : r.mask_end] == (r.text + "<|end|>\n" if r.train else "")
    assert whole["c", "bob"] == "<|user name=amy|>\nhi<|end|>\n<|assistant|>\n<|end|>\n<|user name=amy|>\nbye<|end|>\n"
    assert whole[None, "eve"] == "<|assistant|>\nx<|end|>\n" * 2
    assert whole["d", "unknown"] == "<|assistant|>\nalone<|end|>\n"


def test_empty_tables(docs, spark):
    none = docs.where("false")
    assert bpe.round_trip(none, bpe.default_vocabulary(), keep=["doc_id"]).count() == 0
    assert fingerprint.fingerprints(none).count() == 0
    assert suffix.remove_repeats(none).count() == 0
    assert ngramjoin.keep_one(none).count() == 0
    assert mixing.mix_blocks(none)[1].count() == 0
    assert mixing.mix_documents(none).count() == 0
    assert chat.perspectives(none.select(F.col("lang").alias("conv_id"), F.col("n_chars").alias("turn"), F.col("lang").alias("role"), "text")).count() == 0


def test_null_ids_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, BASE), (None, BASE), (3, BASE), (3, BASE), (3, PASSAGE), (None, None)], "doc_id long, text string")
    assert {r.component_id for r in ngramjoin.jaccard_components(df).where("n_shingles > 100").collect()} == {3}
    assert [r.doc_id for r in ngramjoin.keep_one(df).where("text is not null").collect()] == [3, 3]
    cut = suffix.remove_repeats(df).collect()
    assert len(cut) == 6 and sum(r._n_removed for r in cut) == 4 * len(BASE)
    assert fingerprint.fingerprints(df).count() == 6
    assert mixing.mix_blocks(df.withColumn("source", F.lit("s")))[1].count() == 6
