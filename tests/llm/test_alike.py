"""SimHash components, tokenizer alignment and source divergence against brute force."""
import hashlib
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from mendstream.llm import align, bpe, simhash, skyband

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
RNG = np.random.default_rng(5)
VOCAB = [f"w{i}" for i in range(400)] + ["Straße", "ÉCOLE", "naïve", "漢字"]
LONG = " ".join(RNG.choice(VOCAB, 700))
TEXTS = [
    LONG, LONG, LONG.replace(" ", "\n", 40), LONG + " tail", LONG.replace("w7 ", "w8 "), LONG.upper(), None, "", " \t\n", "one", "One", "one two three", "a b c d", "a b c d", "A B c d e",
    "Ünï çødé 漢字 🙂 don't <|endoftext|> <s> 12 345\n\n  x", "line▁with a piece mark", "x" * 900, "ab " * 400, "word " * 30000,
    *[" ".join(RNG.choice(VOCAB, 60)) for _ in range(20)],
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, [None, "en", "de"][i % 3], ["a", None, "b", "B"][i % 4], 1, 2, "clash", "clash") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, print long, chunk long, term string, _id string").repartition(3).cache()


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_print(text, n=4):
    words = WORD.findall(low(text))
    spans = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, bits):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in combinations(root, 2):
        if (a ^ b).bit_count() <= bits:
            root[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in prints}


def test_simhash_equals_brute_force(docs):
    prints = [plain_print(t) for t in TEXTS]
    of = classes(prints, 4)
    first = {}
    for i, p in enumerate(prints):
        first.setdefault(of[p], i)
    got = {r._id: r for r in simhash.simhash_components(docs).collect()}
    assert {i: (got[i].fingerprint % 2**64, got[i].component_id) for i in got} == {i: (p, first[of[p]]) for i, p in enumerate(prints)}
    assert [r.doc_id for r in simhash.keep_one(docs).orderBy("doc_id").collect()] == sorted(first.values())


def test_long_texts_are_taken_apart_between_words(monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 7)
    monkeypatch.setattr(simhash, "COUNT", 5)
    assert simhash.fingerprint(LONG.encode(), 4) == plain_print(LONG)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=6), st.integers(1, 6))
def test_a_chain_within_budget_starts_somewhere(a, flips, bits):
    x = np.array([sum(1 << b for b in flips)], np.uint64)
    viable = []
    for s in range(bits + 1):
        chains = simhash.chain_masks(bits, s)
        viable.append(int(x[0]) & int(chains[0][0]) == 0 and len(simhash.linked(x, chains, bits)) == 1)
    assert any(viable) == (len(flips) <= bits)


@pytest.mark.parametrize("cell", [4096, 40, 3])
def test_links_do_not_depend_on_the_size_of_cells(spark, cell):
    rng = np.random.default_rng(1)
    prints = set()
    for c in rng.integers(0, 2**63, 6).tolist():  # clouds of near values around a few centres, with many values in the same cells
        for _ in range(45):
            prints.add(c ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)))
    of = classes(sorted(prints), 4)
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    links = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "print long"), 4, cell).collect()
    root = {p: p for p in prints}

    def find(p):
        return p if root[p] == p else find(root[p])

    for a, b in links:
        a, b = a % 2**64, b % 2**64
        assert of[a] == of[b]
        root[max(find(a), find(b))] = min(find(a), find(b))
    assert {p: find(p) for p in prints} == of


def brute_alignment():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    shown = {c: bytes([x]) for c, x in bpe.byte_chars().items()}
    found, links = [], []
    for t in TEXTS:
        rows, text = ([], []), " " + (t or "")
        if t:
            ids = (a.encode(text, add_special_tokens=False).ids, b.encode(t))
            pieces = [b.id_to_piece(i) for i in ids[1]]
            spelt = [[b"".join(shown[c] for c in a.id_to_token(i)) for i in ids[0]], [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in pieces]]
            if all(b"".join(s) == text.encode() for s in spelt):
                for r, s, i in zip(rows, spelt, ids):
                    r.extend(zip(np.cumsum([len(x) for x in s]).tolist(), i))
        both = sorted({e for e, _ in rows[0]} & {e for e, _ in rows[1]})
        groups = []
        of = [defaultdict(list), defaultdict(list)]
        for r, side in zip(rows, of):
            for e, i in r:
                side[bisect_left(both, e)].append(str(i))
        for k in range(len(both)):
            groups.append(",".join(of[0][k]) + "|" + ",".join(of[1][k]))
        end = dict(rows[1])
        linked = [(x, end[e]) for e, x in rows[0] if e in end]
        links.append(linked)
        found.append((len(rows[0]), len(rows[1]), len(groups), len(linked), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    return found, links


@pytest.fixture(scope="module")
def aligned(docs):
    import public_tokenizers

    return align.alignment(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def test_alignment_equals_brute_force(aligned):
    found, links = brute_alignment()
    count = Counter(p for ls in links for p in ls)
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    got = {r._id: r for r in aligned[0].collect()}
    assert len(got) == len(TEXTS)
    for i, (n_a, n_b, n_groups, n_links, sha) in enumerate(found):
        r = got[i]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256) == (n_a, n_b, n_groups, n_links, sha), i
        assert (r.n_best, r.count_sum) == (sum(count[p] == most[p[1]] for p in links[i]), sum(count[p] for p in links[i])), i
    assert found[16] == (0, 0, 0, 0, "") and found[6] == found[7] == found[16]
    pairs = {(r.a, r.b): (r.docs, r.links) for r in aligned[1].collect()}
    assert pairs == {p: (sum(p in set(ls) for ls in links), n) for p, n in count.items()}


def test_alignment_in_small_pieces(docs, aligned, monkeypatch):
    """Small chunks, many flushes: bitmaps in several pieces and chunks, the same result."""
    import public_tokenizers

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    monkeypatch.setattr(align, "TOGETHER", 200)
    monkeypatch.setattr(align, "ENTRIES", 50)
    for x, y in zip(aligned, align.alignment(docs.repartition(2), *paths)):
        assert sorted(map(str, x.collect())) == sorted(map(str, y.collect()))


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.tuples(st.integers(0, 3), st.integers(0, 65535)), st.integers(1, 9), min_size=1, max_size=60), st.booleans())
def test_planes_give_their_members_back(entries, dense):
    if dense:
        entries |= {(1, b): 1 + b % 6 for b in range(0, 65536, 3)}
    keys = sorted(entries)
    pair, bit, times = (np.array(x, np.int64) for x in (*zip(*keys), [entries[k] for k in keys]))
    names, postings = align.planes(pair, bit.astype(np.uint16), times)
    back = Counter()
    for row, b, weight in align.members(postings):
        for k in zip(names[row].tolist(), b.tolist(), weight.tolist()):
            back[k[:2]] += k[2]
    assert back == entries


def brute_divergence(rows, least, top):
    docs = [(t or "", lang or "", source or "") for t, lang, source in rows]
    seen, count, total = defaultdict(set), Counter(), Counter()
    for i, (t, lang, source) in enumerate(docs):
        for w in TERM.findall(low(t)):
            seen[lang, w].add(i)
            count[lang, source, w] += 1
            total[lang, w] += 1
    out = []
    groups = sorted({d[1:] for d in docs})
    for lang, source in groups:
        kept = [w for (x, w), s in seen.items() if x == lang and len(s) >= least]

        def profile(c):
            n = sum(c(w) for w in kept)
            return {w: 1 + 10**9 * (c(w) + 5) // (n + 5 * len(kept)) for w in kept}

        p, q = profile(lambda w: count[lang, source, w]), profile(lambda w: total[lang, w])
        parts = {"pair": [], "term": [(q[w] - p[w], w.encode(), w) for w in kept if count[lang, source, w] and p[w] > q[w]]}
        for x, other in groups:
            if x == lang and other != source:
                o = profile(lambda w, other=other: count[lang, other, w])
                parts["pair"].append((-sum(abs(p[w] - o[w]) for w in kept), other.encode(), other))
        for part, items in parts.items():
            out += [(lang, source, part, item, -v, k) for k, (v, _, item) in enumerate(sorted(items), 1) if part == "pair" or k <= top]
    return sorted(out)


@pytest.mark.parametrize("least,top", [(3, 4), (1, 50), (1000, 5)])
def test_divergence_equals_brute_force(docs, least, top):
    rows = [(r.text, r.lang, r.source) for r in docs.collect()]
    got = skyband.divergence(docs, least_docs=least, top=top).select("lang", "source", "part", "item", "value", "rank").collect()
    assert sorted(map(tuple, got)) == brute_divergence(rows, least, top)


def test_skyband_keeps_all_that_few_dominate(spark, monkeypatch):
    monkeypatch.setattr(skyband, "GRID", 64)
    rng = np.random.default_rng(2)
    rows = [("g" if i % 3 else "h", int(rng.integers(0, 12)), int(rng.integers(0, 12)), f"{chr(97 + i % 26)}é{i}") for i in range(500)]
    got = {r.t for r in skyband.skyband(spark.createDataFrame(rows, "g string, hi long, lo long, t string").repartition(5), ["g"], "hi", "lo", "t", 4).collect()}
    want = {r[3] for r in rows if sum(x[0] == r[0] and x[1] >= r[1] and x[2] <= r[2] and x[3].encode() < r[3].encode() for x in rows) < 4}
    assert got == want


def test_empty_tables_repeated_rows_and_null_ids(docs, spark):
    import public_tokenizers

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    none = docs.where("false")
    assert simhash.simhash_components(none).count() == skyband.divergence(none).count() == align.alignment(none, *paths)[0].count() == 0
    df = spark.createDataFrame([(None, LONG), (None, LONG), (3, LONG), (3, LONG), (2, None), (None, "")], "doc_id long, text string")
    got = simhash.simhash_components(df).collect()
    assert len(got) == 6 and sorted((r._id or 0, r.component_id) for r in got) == [(0, 2), (0, 3), (0, 3), (2, 2), (3, 3), (3, 3)]
    assert align.alignment(df, *paths)[0].where(F.col("n_a") > 0).count() == 4


def test_terms_of_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(skyband, "PIECE", 16)
    monkeypatch.setattr(skyband, "HELD", 5)
    df = spark.createDataFrame([(t, "l", "s") for t in [LONG[:900], "x" * 50 + " Y" * 30, "é" * 40, None]], "text string, lang string, source string")
    got = {r.term: (r.n, r.docs) for r in skyband.term_counts(df, "text", "lang", "source").collect()}
    lists = [TERM.findall(low(r.text)) for r in df.collect()]
    assert got == {t: (sum(x.count(t) for x in lists), sum(t in x for x in lists)) for t in {t for x in lists for t in x}}
