import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tablewright.llm import fingerprint, ngram_join
from tablewright.llm.base import shingle_sets, word_bounds, utf8

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) >= 5:
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def brute_components(rows):
    """doc_id to (set size, least doc_id reachable), from all pairs."""
    sets = {i: brute_set(t) for i, t in rows}
    ids, parent = sorted(sets), {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def edited_copies(rnd, words, n, edits):
    out = []
    for _ in range(n):
        copy = list(words)
        for _ in range(rnd.randint(0, edits)):
            copy[rnd.randrange(len(copy))] = f"w{rnd.randint(0, 10**6)}"
        out.append(" ".join(copy))
    return out


@pytest.fixture(scope="module")
def similar_rows():
    """Groups of copies with few to many edits (links that do not carry over), short sets, a shared passage."""
    rnd = random.Random(12)
    texts = []
    passage = [f"p{k}" for k in range(60)]
    for g in range(12):
        words = [f"w{rnd.randint(0, 500)}" for _ in range(rnd.choice((6, 9, 14, 25, 60, 150, 300)))]
        texts += edited_copies(rnd, words, rnd.choice((2, 3, 8, 20)), max(1, len(words) // 12))
        texts += [" ".join(words[:k]) for k in (len(words), int(len(words) * 0.9), int(len(words) * 0.8), int(len(words) * 0.7))]
    texts += [" ".join([f"q{rnd.randint(0, 900)}" for _ in range(40)] + passage + [f"q{rnd.randint(0, 900)}" for _ in range(30)]) for _ in range(25)]
    texts += ["a b c d e f g", "A b c d e f G h", "a b c d", "a  b c D", "a b c", "x", "X", "", None, " \n", "ä Ä", "ä ä", "ä Ä"]
    rnd.shuffle(texts)
    return list(enumerate(texts))


def test_shingles_equal_brute_force():
    texts = ["", None, "a", " a  b ", "a b c d e", "A B\tc\x0bd e\nf a b c d e f", "é" * 600 + " x y z w v", "x" * 300 + " b c d e"]
    flat, offsets = shingle_sets(pa.array(texts))
    assert np.diff(offsets).tolist() == [len(brute_set(t)) for t in texts]
    for t, a, b in zip(texts, offsets[:-1], offsets[1:]):
        alone, _ = shingle_sets(pa.array([t], pa.string()))
        assert alone.tolist() == flat[a:b].tolist()
    data, rows = utf8(pa.array(["ab", "cd", "", " e"]))
    starts, ends, words = word_bounds(data, rows)
    assert (starts.tolist(), ends.tolist(), words.tolist()) == ([0, 2, 5], [2, 4, 6], [0, 1, 2, 2, 3])


def test_components_equal_all_pairs(spark, similar_rows, monkeypatch):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in similar_rows], "doc_id long, text string, set_id string, n int")
    want = brute_components(similar_rows)
    assert sum(c != i for i, (_, c) in want.items()) > 40

    def found(frame):
        return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.similar_documents(frame).collect()}

    assert found(docs) == want
    # Small blocks: hubs and tiles are split.
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    assert found(docs.repartition(5)) == want
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, (_, c) in want.items() if c == i}


def brute_links(rows):
    """doc_id to the number of other documents it links with, from all pairs."""
    sets = [(i, brute_set(t)) for i, t in rows]
    return {i: sum(i != j and bool(x) and bool(y) and 100 * len(x & y) >= 75 * len(x | y) for j, y in sets) for i, x in sets}


def test_every_link_is_counted(spark, similar_rows, odd_docs, monkeypatch):
    rnd = random.Random(31)
    # One large group of near copies: most of its links are implied by others.
    words = [f"n{k}" for k in range(70)]
    rows = similar_rows + [(5000 + k, t) for k, t in enumerate(edited_copies(rnd, words, 150, 3))]
    rows += [(r["doc_id"], r["text"]) for r in odd_docs.select(odd_docs.doc_id + 9000, "text").toDF("doc_id", "text").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_links({r for r in rows if r[0] is not None}) | {None: 0}
    assert max(want.values()) > 20
    # Small blocks and few dense columns: tiles are cut into many jobs.
    for name, value in (("PAIR_BLOCK", 40), ("PAIR_SHINGLES", 3000), ("DENSE_COLUMNS", 50), ("DENSE", 4)):
        monkeypatch.setattr(ngram_join, name, value)
    assert {r["doc_id"]: r["n_links"] for r in ngram_join.similar_documents(docs).collect()} == want


def test_shared_counts_equal_sets():
    rnd = random.Random(6)
    for m in (1, 2, 40):
        rows = [sorted({rnd.randint(0, rnd.choice((5, 60, 3000))) for _ in range(rnd.randint(0, 90))}) for _ in range(m)]
        got = ngram_join.shared_counts(np.array(sum(rows, []), np.int64), np.array([len(r) for r in rows]))
        assert all(got[i, j] == len(set(rows[i]) & set(rows[j])) for i in range(m) for j in range(m) if i != j)


def test_join_edges(odd_docs, no_docs):
    rows = ngram_join.similar_documents(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    found = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows}
    want = brute_components({(r["doc_id"], r["text"]) for r in odd_docs.collect() if r["doc_id"] is not None})
    assert {(d, n, c) for d, n, c in found if d is not None} == {(d, n, c) for d, (n, c) in want.items()}
    assert {c for d, _, c in found if d in (5, 6)} == {5}
    assert (1, 0, 1) in found and (8, 0, 8) in found and {c for d, _, c in found if d is None} == {None}
    assert {c for d, _, c in found if d in (12, 13)} == {12} and (14, 1, 14) in found
    assert ngram_join.similar_documents(no_docs).count() == ngram_join.one_of_each(no_docs).count() == 0


def test_bitmaps_bound_the_overlap():
    rnd = np.random.default_rng(4)
    for _ in range(200):
        common = rnd.integers(0, 2**63, rnd.integers(1, 400), np.int64).astype(np.uint64)
        a = np.unique(np.concatenate([common, rnd.integers(0, 2**63, rnd.integers(0, 60), np.int64).astype(np.uint64)]))
        b = np.unique(np.concatenate([common, rnd.integers(0, 2**63, rnd.integers(0, 60), np.int64).astype(np.uint64)]))
        maps = [ngram_join._bitmaps(x, np.array([0, len(x)]))[0] for x in (a, b)]
        words = min(map(len, maps)) // 8
        differing = int(np.bitwise_count(ngram_join._folded(maps[0], words) ^ ngram_join._folded(maps[1], words)).sum())
        overlap = len(np.intersect1d(a, b))
        assert differing <= len(a) + len(b) - 2 * overlap
        if 4 * overlap >= 3 * (len(a) + len(b) - overlap):
            assert ngram_join._may_link(len(a), len(b), differing)


# Fingerprints

M = 2**64


def plain_mix(h):
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        h = (h ^ (h >> shift)) * factor % M
    return h


def plain_word(word):
    if len(word) > 256:
        return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    h = plain_mix((len(word) + 0x9E3779B97F4A7C15) % M)
    for k in range(0, len(word), 8):
        h = plain_mix((h * 0x9E3779B97F4A7C15 + int.from_bytes(word[k:k + 8], "little")) % M)
    return h


def plain_terms(text):
    return {plain_word(w) for w in re.findall(rb"[^\x20\x09-\x0D]+", text.translate(LOWER).encode())}


def plain_fingerprint(text, lexicon):
    """Hashes of the sums over a text's terms, subset by subset, with whole numbers."""
    held, parts = plain_terms(text) & lexicon, []
    for seed in range(fingerprint.SEEDS):
        for level in fingerprint.LEVELS:
            drawn = [plain_mix(t ^ ((seed + 1) * 0x9E3779B97F4A7C15 % M)) for t in held]
            drawn = [d for d in drawn if d >> (64 - level) == 0]
            parts.append(max(1, plain_mix(sum(plain_mix((d + level) % M) for d in drawn) % M)) if drawn else 0)
    parts.append(0 if held else max(1, int(hashlib.sha256(text.encode()).hexdigest()[:16], 16)))
    return parts


def plain_likeness(a, b):
    if a == b:
        return 1.0
    used = [(x, y) for x, y in zip(a[:-1], b[:-1]) if x or y]
    return sum(x == y for x, y in used) / len(used) if used else 0.0


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_neighbours_equal_plain_loop(spark, odd_docs, small_docs, no_docs, partitions):
    for docs in (odd_docs, small_docs.limit(60)):
        rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        lexicon = fingerprint.build_lexicon(docs, most_share=0.9)
        counts = {}
        for _, text in rows:
            for t in plain_terms(text):
                counts[t] = counts.get(t, 0) + 1
        band = {t for t, n in counts.items() if 2 <= n <= 0.9 * len(rows)}
        assert band == set(lexicon.terms.tolist()) and band
        want = []
        for k, (doc_id, text) in enumerate(rows):
            following = rows[(k + 1) % len(rows)][1]
            new = fingerprint.edited(text, following)
            prints = [plain_fingerprint(t, band) for t in (text, new, following)]
            want.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), *["".join(f"{h:016x}" for h in p) for p in prints[:2]],
                         plain_likeness(*prints[:2]), plain_likeness(prints[0], prints[2])))
        got = [tuple(r) for r in fingerprint.compare_neighbours(docs, lexicon, partitions).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
        assert all(fingerprint.likeness(r[3], r[4]) == r[5] for r in got)
    one = odd_docs.where("doc_id = 5").limit(1)
    assert [r["near_next"] for r in fingerprint.compare_neighbours(one, lexicon).collect()] == [1.0]
    assert fingerprint.compare_neighbours(no_docs, fingerprint.build_lexicon(no_docs), partitions).count() == 0


def test_texts_are_shuffled_once_and_documents_keep_their_columns(spark, odd_docs, small_docs):
    lexicon = fingerprint.build_lexicon(small_docs)
    frame = fingerprint.compare_neighbours(small_docs, lexicon, 4)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan
    marked = fingerprint.fingerprint_documents(odd_docs, lexicon)
    assert sorted(marked.columns) == sorted(odd_docs.columns) and marked.columns[-1] == "fingerprint"
    for r in marked.collect():
        assert r["fingerprint"] == lexicon.fingerprints(pa.array([r["text"]], pa.string()))[0] and r["score"] == "score"


def test_lexicon_holds_the_band(spark):
    texts = ["common rare%d mid%d" % (k, k % 10) for k in range(100)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["term"]: r["df"] for r in fingerprint.document_frequencies(docs).collect()}
    assert sorted(found.values()) == sorted([100] + [1] * 100 + [10] * 10)
    lexicon = fingerprint.build_lexicon(docs, least_share=0.05, most_share=0.5)
    assert sorted(np.int64(t.view(np.int64)) for t in lexicon.terms) == sorted(t for t, n in found.items() if n == 10)


def test_equal_texts_agree_and_unlike_ones_differ(small_docs):
    lexicon = fingerprint.build_lexicon(small_docs)
    texts = [r["text"] for r in small_docs.collect()]
    prints = lexicon.fingerprints(pa.array(texts + texts[:20] + ["", "zzz", "zzz", "yyy", None]))
    assert prints[:20] == prints[len(texts):len(texts) + 20]
    assert prints[-4] == prints[-3] != prints[-2] and prints[-5] == prints[-1]
    assert fingerprint.likeness(prints[-4], prints[-2]) == 0 and fingerprint.likeness(prints[0], prints[0]) == 1
    rows = fingerprint.compare_neighbours(small_docs, lexicon).collect()
    assert sum(r["near_edited"] for r in rows) > 5 * sum(r["near_next"] for r in rows)
