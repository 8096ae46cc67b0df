import random
import re

import pyarrow as pa
import pytest

from tablewright.llm import decontaminate as dc
from tablewright.llm import language, license_scan, secret_scan, url_filter
from tablewright.llm.components import components


# Secrets

def brute_spans(text):
    either = "".join
    key = "|".join(either(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token"))
    api = "[aA][pP][iI]_?[kK][eE][yY]"
    found = [(m.start(), 0, m.end()) for m in re.finditer(
        f"({key}|{api})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def test_base_spans_equal_plain_search():
    rnd = random.Random(2)
    parts = ["token", "SECRET", "Api_Key", "apikey", "passwd", "paſsword", "toKen", "=", ": ", "\"", "'", " ", "AKIA", "0f" * 16,
             "abcdef01" * 5, "AKIA" + "Z9" * 8, "short", "long.value-12", "\n", "é", "token=token=abcdefgh"]
    for _ in range(2000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12)))
        assert secret_scan.base_spans(text) == brute_spans(text)
        found = next(secret_scan._found(pa.array([text]), None))[1]
        assert [s[:3] for s in found] == brute_spans(text)


def test_markov_model_tells_random_from_ordinary(spark, small_docs):
    model = secret_scan.train(small_docs)
    rnd = random.Random(7)
    letters = secret_scan.ALPHABET[:62]
    random_strings = ["".join(rnd.choice(letters) for _ in range(32)) for _ in range(300)]
    words = [w for r in small_docs.collect() for w in re.findall("[A-Za-z]{4,}", r["text"])][:3000]
    ordinary = ["_".join(words[i:i + 4]) for i in range(0, 1200, 4)]
    assert sum(model.score(s) > model.threshold for s in random_strings) > 290
    assert sum(model.score(s) > model.threshold for s in ordinary) < 5
    planted = spark.createDataFrame([(1, f"é see {random_strings[0]} and token={random_strings[1]} here"), (2, ordinary[0])], "doc_id long, text string")
    rows = {r["doc_id"]: r["spans"] for r in secret_scan.find_secrets(planted, model).collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in rows[1]] == [("markov", 6, 38), ("assign", 43, 81)]
    assert [s["score"] for s in rows[1]] == [model.score(t) for t in random_strings[:2]]
    assert rows[2] == []
    masked = {r["doc_id"]: r["text"] for r in secret_scan.mask_secrets(planted, model).collect()}
    assert masked == {1: "é see [SECRET] and [SECRET] here", 2: ordinary[0]}


def test_pair_models_and_spans_equal_plain_counts(spark, small_docs):
    """Both models counted pair by pair, and every span found by looking at each run by itself."""
    rnd = random.Random(9)
    letters = secret_scan.ALPHABET[:62]
    texts = [r["text"] or "" for r in small_docs.collect()]
    texts += [f"{texts[k]} {''.join(rnd.choice(letters) for _ in range(rnd.randint(10, 40)))} é {texts[k][:50]}" for k in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = secret_scan.train(docs, sample_rows=10**9)
    size = len(secret_scan.ALPHABET)
    counts = [[[1.0] * size for _ in range(size)] for _ in range(2)]
    place = {c: i for i, c in enumerate(secret_scan.ALPHABET)}

    def apart(run, spans):
        return all(b <= run.start() or a >= run.end() for a, _, b in spans)

    def value(text, a, kind, b):
        return re.search(r"[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)$", text[a:b])[1] if kind == 0 else text[a:b]

    for text in texts:
        spans = brute_spans(text)
        strings = [(1, r) for a, kind, b in spans for r in re.findall(r"[A-Za-z0-9+/_=-]+", value(text, a, kind, b))]
        strings += [(0, m[0]) for m in re.finditer(r"[A-Za-z0-9+/_=-]+", text) if len(m[0]) >= 4 and apart(m, spans)]
        for label, run in strings:
            for x, y in zip(run, run[1:]):
                counts[label][place[x]][place[y]] += 1
    import math
    ratio = [math.log((0.5 * r / sum(rows_r) + 0.5 / size) / (o / sum(rows_o)))
             for rows_o, rows_r in zip(*counts) for o, r in zip(rows_o, rows_r)]
    assert model.ratio.tolist() == pytest.approx(ratio, rel=1e-9, abs=1e-12)

    def mean(run):
        pairs = [ratio[place[x] * size + place[y]] for x, y in zip(run, run[1:])]
        return sum(pairs) / len(pairs)

    n_markov = 0
    for r in secret_scan.find_secrets(docs, model).collect():
        text = texts[r["doc_id"]]
        spans = brute_spans(text)
        want = [(a, kind, b) for a, kind, b in spans] + [(m.start(), 3, m.end()) for m in re.finditer(r"[A-Za-z0-9+/_=-]+", text)
                                                          if len(m[0]) >= 12 and apart(m, spans) and mean(m[0]) > 0.5]
        n_markov += sum(k == 3 for _, k, _ in want)
        assert [(s["start"], secret_scan.KINDS.index(s["kind"]), s["end"]) for s in r["spans"]] == sorted(want)
    assert n_markov > 40


def test_many_spans_in_one_text_take_linear_time():
    import time
    text = " ".join("token=abcdefgh12345678 someordinarywordsthatarelong" for _ in range(100_000))
    began = time.perf_counter()
    model = secret_scan.MarkovModel(secret_scan.np.zeros(len(secret_scan.ALPHABET) ** 2))
    found = next(secret_scan._found(pa.array([text]), model))[1]
    assert len(found) == 100_000 and time.perf_counter() - began < 20


def test_secret_edge_cases(odd_docs, no_docs):
    model = secret_scan.train(odd_docs)
    rows = secret_scan.find_secrets(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and sum(r["doc_id"] is None for r in rows) == 2
    masked = secret_scan.mask_secrets(odd_docs, model)
    assert masked.columns == odd_docs.columns
    assert masked.where("text IS NULL").count() == odd_docs.where("text IS NULL").count()
    assert secret_scan.find_secrets(no_docs, secret_scan.train(no_docs)).count() == 0


# Languages

def test_language_accuracy_and_edges(spark, odd_docs, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.train(docs.where(~language.held_out()))
    rows = language.identify(docs, model).where(language.held_out()).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) > 0.99 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    odd = language.identify(odd_docs, model)
    assert odd.columns == [c for c in odd_docs.columns if c not in ("lang_pred", "score")] + ["lang_pred", "score"]
    for r in odd.collect():
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or "")), r["doc_id"]
    assert {r["lang_pred"] for r in language.identify(odd_docs, language.train(no_docs)).collect()} == {"und"}
    assert language.identify(no_docs, model).count() == 0


def test_language_equals_sets_of_plain_ngrams(spark, small_docs):
    """The same decision with n-grams cut from plain strings, counted in dictionaries and kept in sets."""
    from collections import Counter
    from unicodedata import category
    M = 2**64

    def mix(h):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            h = (h ^ (h >> shift)) * factor % M
        return h

    def plain_grams(text):
        letters = "".join((c.lower() if len(c.lower()) == 1 else c) if category(c)[0] == "L" else " " for c in text or "")
        padded = " " + " ".join(letters.split()) + " " if letters.split() else " "
        found = [padded[i:i + n] for n in language.SIZES for i in range(len(padded) - n + 1)]
        return [g for g in found if " " not in g[1:-1] and not (g[0] == g[-1] == " ")]

    def order(gram):
        h = len(gram)
        for c in gram:
            h = (h * 0x9E3779B97F4A7C15 + ord(c)) % M
        h = mix(h)
        return h - M if h >= M // 2 else h

    rows = small_docs.collect()
    counts, sizes = {}, Counter()
    for r in rows:
        if r["lang"] is not None:
            sizes[r["lang"]] += 1
            counts.setdefault(r["lang"], Counter()).update(plain_grams(r["text"]))
    names = sorted(sizes, key=lambda n: (-sizes[n], n))
    held = {n: {g for g, _ in sorted(counts[n].items(), key=lambda x: (-x[1], order(x[0])))[:400]} for n in names}
    model = language.train(small_docs, sample_rows=10**9, per_language=400)
    assert list(model.languages) == names
    odd = [(10**6 + k, t, None) for k, t in enumerate(("", None, "1234", "Ünïcode ß", "a", " b c "))]
    frame = small_docs.select("doc_id", "text", "lang").union(spark.createDataFrame(odd, "doc_id long, text string, lang string"))
    close = 0
    for r in language.identify(frame, model).collect():
        grams = plain_grams(r["text"])
        shares = [sum(g in held[n] for g in grams) / max(1, len(grams)) for n in names]
        if not any(category(c)[0] == "L" for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif sorted(shares)[-1] - sorted(shares)[-2] > 0.02:
            assert r["lang_pred"] == names[shares.index(max(shares))] and r["score"] == pytest.approx(max(shares), abs=0.01)
            close += 1
    assert close > 190


def test_language_filter_answers_as_sets():
    model = language.build(["x", "y"], [("x", k * 977 - 5000) for k in range(300)] + [("y", k * 977 - 5000) for k in range(200, 500)], 3, 1 << 14)
    import numpy as np
    masks = model.masks((np.arange(500) * 977 - 5000).view(np.uint64)).tolist()
    assert all(m & 1 for m in masks[:300]) and all(m & 2 for m in masks[200:500])
    assert sum(m & 2 > 0 for m in masks[:200]) < 20


def test_language_does_not_depend_on_batches():
    texts = ["The cat", "", None, "a", "Größe é", "  x  y ", "日本"] * 3
    whole, offsets, letters = language.grams(pa.array(texts))
    for i, t in enumerate(texts):
        one, _, n = language.grams(pa.array([t], pa.string()))
        assert sorted(one.tolist()) == sorted(whole[offsets[i]:offsets[i + 1]].tolist()) and n[0] == letters[i]


# Benchmark leaks

def brute_distance(pattern, text):
    prev = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        cur = [i]
        for j, d in enumerate(text, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (c != d)))
        prev = cur
    return min(prev), prev.index(min(prev))


def test_distance_and_search_equal_brute_force():
    rnd = random.Random(3)
    for _ in range(400):
        text = "".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 60)))
        items = [dc.Item(k, "".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 14))), 0) for k in range(3)]
        for item in items:
            item.budget = rnd.randint(0, len(item.text) // 4)
            assert dc.nearest_end(dc.masks_of(item.text), len(item.text), text) == brute_distance(item.text, text)
        found = {item.item_id: place for item, *place in dc.Finder(items).find(text)}
        assert {k: p[0] for k, p in found.items()} == {i.item_id: d for i in items if (d := brute_distance(i.text, text)[0]) <= i.budget}
        for k, (distance, start, end) in found.items():
            assert brute_distance(items[k].text, text[start:end])[0] == distance


def test_leaks_in_documents(spark, odd_docs, no_docs):
    item = "What is the name of the longest river that flows through the old town of the valley?"
    edited = item.replace("name", "nane").replace("river", "rivers").upper()
    bench = spark.createDataFrame([(1, item), (2, item), (3, None), (4, "  "), (None, "zz unique probe zz")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"so: {edited}  end"), (2, f"x {item[:40]}\n\n{item[40:]}"), (3, item[:50]), (4, None), (5, ""),
                                  (6, "word " * 50_000 + item), (7, "a zz unique  probe zz"), (7, "a zz unique  probe zz")], "doc_id long, text string")
    found = sorted(((r["doc_id"], r["item_id"], r["distance"]) for r in dc.find_leaks(docs, bench).collect()), key=str)
    assert found == sorted([(1, 1, 2), (1, 2, 2), (2, 1, 1), (2, 2, 1), (6, 1, 0), (6, 2, 0), (7, None, 0), (7, None, 0)], key=str)
    assert sorted(r["doc_id"] for r in dc.without_leaks(docs, bench).collect()) == [3, 4, 5]
    assert dc.without_leaks(odd_docs, bench).columns == odd_docs.columns
    assert dc.find_leaks(no_docs, bench).count() == dc.find_leaks(docs, bench.limit(0)).count() == 0
    assert len(list(dc.item_blocks(bench, 0.05, block_chars=10))) == 3


def test_benchmarks_of_many_blocks_give_the_same(spark, odd_docs, no_docs):
    """Blocks of one item each, written one after the other, against one block of all."""
    rnd = random.Random(4)
    items = [" ".join(rnd.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rnd.randint(0, 9)) for _ in range(rnd.randint(3, 30)))
             for _ in range(12)]
    bench = spark.createDataFrame([(k if k != 5 else None, t) for k, t in enumerate(items)] + [(90, None), (91, " ")], "item_id long, text string")
    texts = [f"begin {rnd.choice(items)} and {rnd.choice(items).upper()} end" if k % 3 else "nothing here" for k in range(60)] + ["", None, items[0] * 500]
    extra = ("__leak_1", "h1", "h2")
    docs = spark.createDataFrame([(k % 50 if k % 7 else None, t, *extra) for k, t in enumerate(texts)], "doc_id long, text string, " + ", ".join(f"{c} string" for c in extra[1:] + ("key",)))
    whole = sorted(map(str, dc.find_leaks(docs, bench).collect()))
    assert len(whole) > 60 and sorted(map(str, dc.find_leaks(docs, bench, block_chars=1).collect())) == whole
    kept = dc.without_leaks(docs, bench)
    many = dc.without_leaks(docs, bench, block_chars=1)
    assert many.columns == kept.columns == docs.columns
    assert sorted(map(str, many.collect())) == sorted(map(str, kept.collect())) and kept.count() == 22
    for frame in (odd_docs, no_docs):
        assert sorted(map(str, dc.without_leaks(frame, bench, block_chars=1).collect())) == sorted(map(str, dc.without_leaks(frame, bench).collect()))


# Licences

def test_licenses_by_brute_force(spark, odd_docs, no_docs):
    rnd = random.Random(11)
    words = "work is licensed under the general this public license version released mit apache foo bar".split()
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 60))) for _ in range(150)]
    for k in range(60):
        notice = rnd.choice(list(license_scan.NOTICES.values())).split()
        if k % 2:
            notice[rnd.randrange(len(notice))] = "changed"
        texts[k] = f"{texts[k]} {' '.join(notice)}, {texts[k + 60]}"
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def shingles(text):
        w = [x for x in re.split(r"[^\w]+|_", text.lower()) if x]
        return [tuple(w[i:i + 5]) for i in range(len(w) - 4)]

    want = {}
    for i, t in enumerate(texts):
        found = shingles(t)
        for name, notice in license_scan.NOTICES.items():
            one = set(shingles(notice))
            width = len(one) + max(1, len(one) // 4) - 1
            best = max((len(one.intersection(found[s:s + width])) / len(one)
                        for s in range(0, max(1, len(found)), max(1, len(one) // 4))), default=0)
            if best >= 0.75:
                want[i, name] = best
    got = {(r["doc_id"], r["license"]): r["containment"] for r in license_scan.scan_licenses(docs).collect()}
    assert set(got) <= set(want) and len(got) >= 0.98 * len(want) and all(got[k] == pytest.approx(want[k]) for k in got)
    assert len([k for k in got if got[k] == 1.0]) == len([k for k in want if want[k] == 1.0])
    assert license_scan.scan_licenses(odd_docs).count() == license_scan.scan_licenses(no_docs).count() == 0
    assert license_scan.bands_for(0.5, 1, 0.999) == 10


def test_licenses_with_inserted_words(spark):
    """Held against the containment in the whole text, at all offsets of a step."""
    texts, want = [], set()
    for name in ("BSD-3-Clause", "MIT-text"):
        notice = re.findall(r"\w+", license_scan.NOTICES[name].lower())
        one = {tuple(notice[i:i + 5]) for i in range(len(notice) - 4)}
        for n_added in (1, 2, 6):
            for at in range(1, len(notice)):
                for offset in range(5):
                    words = notice[:at] + [f"x{k}" for k in range(n_added)] + notice[at:]
                    text = [f"f{k}" for k in range(offset)] + words + [f"g{k}" for k in range(30)]
                    found = {tuple(text[i:i + 5]) for i in range(len(text) - 4)}
                    if len(one & found) >= 0.75 * len(one):
                        want.add((len(texts), name, len(one & found) / len(one)))
                    texts.append(" ".join(text))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["license"], r["containment"]) for r in license_scan.scan_licenses(docs).collect()}
    assert len(want) > 200 and got <= want and len(got) >= 0.998 * len(want)


# Addresses

def test_edges_of_common_html(spark):
    base = "http://c.org/a/b?q=1"
    cases = [('<link href="http://x.org/1" rel="canonical">', "http://x.org/1"), ("<LINK href=http://x.org/2?a=1 rel=canonical>", "http://x.org/2?a=1"),
             ("<meta content='0;URL=http://x.org/3' http-equiv=Refresh />", "http://x.org/3"),
             ('<meta http-equiv="refresh" content="0; url=\'http://x.org/4\'">', "http://x.org/4"),
             ("<link rel='nofollow canonical' title='a > b' href='/es/q'>", "http://c.org/es/q"), ("<link rel=canonical href=d/./e>", "http://c.org/a/d/e"),
             ("<link rel=canonical href='../../up?x=a/../b'>", "http://c.org/up?x=a/../b"), ("<link rel=canonical href='//y.org/z'>", "http://y.org/z"),
             ("<link rel=canonical href='?p=2'>", "http://c.org/a/b?p=2"), ("<link rel=canonical href='http://x.org/?a&amp;b'>", "http://x.org/?a&b"),
             ("<base href='/deep/er/'><link rel=canonical href=f>", "http://c.org/deep/er/f"),
             ("<link rel=stylesheet href=/s.css title='rel=canonical'>", None), ("<link rel=canonical href='mailto:canonical@x'>", None),
             ("<meta name=refresh content='0; url=http://x.org/5'>", None), ("<link rel=canonical href=''>", None)]
    pages = spark.createDataFrame([(base + f"#{k}", "<p>canonical</p>" + html) for k, (html, _) in enumerate(cases)], "url string, html string")
    got = {(r["source"], r["target"]) for r in url_filter.page_edges(pages).collect()}
    assert got == {(base + f"#{k}", target) for k, (_, target) in enumerate(cases) if target}
    # Every link of a page counts, not the first of its kind.
    two = spark.createDataFrame([("http://c.org", "".join(f"<link rel=canonical href={k}>" for k in "de"))], "url string, html string")
    assert sorted(r["target"] for r in url_filter.page_edges(two).collect()) == ["http://c.org/d", "http://c.org/e"]


def plain_verdicts(pages, edges, rules=url_filter.PAGE_RULES):
    """Verdicts by union-find over addresses; the given edges are (source, target)."""
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    def parts(url):
        if "://" not in url:
            return "", "", url
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        asked = re.match(r"[^?#]*\?([^#]*)", rest[len(host):])
        asked = re.sub("^&", "", re.sub(url_filter.TRACKING, "", asked[1] if asked else ""))
        host = "".join(c.lower() if c.isascii() else c for c in host)
        return host, path, re.sub(r"^(www|m)\.", "", host) + re.sub(r"(/|\.html)$", "", path) + "?" + asked

    def rule(url):
        host, path, _ = parts(url)
        fits = [(len(h + p), a == "allow", h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[2:] if fits else (None, None)

    urls = {u for _, u, _ in pages if u is not None} | {u for e in edges for u in e}
    for a, b in [*edges, *[(u, ("form", parts(u)[2])) for u in urls]]:
        a, b = root(a), root(b)
        parent[a] = b
    actions = {}
    for u in urls:
        actions.setdefault(root(u), set()).add(rule(u)[1])
    out = []
    for page_id, u, _ in pages:
        host, path, _ = parts(u) if u is not None else ("", "", "")
        name, action = rule(u) if u is not None else (None, None)
        group = actions[root(u)] if u is not None else set()
        out.append((page_id, host, path, name, action or ("block" if "block" in group and "allow" not in group else "allow")))
    return sorted(out, key=str)


def test_tables_with_tags_against_union_find_and_sql(spark, tmp_path):
    """Chains of links in all spellings, mirrors, tracking parameters and a very long address."""
    import duckdb
    rnd = random.Random(6)
    hosts = ["a.org", "www.a.org", "b.net", "m.b.net", "example.com", "www.example.com", "x.example.com", "C.de"]
    paths = ["/en/", "/es/", "/fr/x", "/en/1.html", "/q/", "/q", "/en/a/b", ""]
    urls = [f"{rnd.choice(['http', 'https'])}://{rnd.choice(hosts)}{rnd.choice(paths)}{rnd.choice(['', '', '?utm_source=1', '?id=2&ref=x', '#top'])}" for _ in range(150)]
    urls += [f"http://k{k}.org/{k % 7}" for k in range(120)] + ["no address", "http://", "", "http://long.org/" + "x/" * 20_000]
    spellings = ["<link rel=canonical href='{}'>", '<LINK href="{}" REL="canonical">', "<link href={} rel=canonical />", "<meta http-equiv=refresh content='0;url={}'>",
                 '<meta content="3; URL=\'{}\'" http-equiv="Refresh">', "<p title='canonical'><link rel='x canonical' title='a > b' href=\"{}\">"]
    pages, edges = [(0, None, "<link rel=canonical href=http://a.org/>")], set()
    for k, url in enumerate(urls):
        html = "<p>text</p>"
        if rnd.random() < 0.5:
            to = rnd.choice(urls)
            if "://" in to:
                html += rnd.choice(spellings).format(to)
                edges.add((url, to))
        elif url.startswith("http://k") and rnd.random() < 0.5:
            host = url.rsplit("/", 1)[0]
            html += rnd.choice(spellings).format(rnd.choice(["./other/../9", "/9", "9"]))
            edges.add((url, f"{host}/9"))
        pages += [(k + 1, url, html)] * rnd.choice([1, 1, 2])
    pages.append((999, "http://a.org/none", None))
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {(r["source"], r["target"]) for r in url_filter.page_edges(frame).collect()}
    assert found == edges and len(edges) > 100
    frame.coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = [tuple(r) for r in url_filter.op9_url_filter(spark, str(tmp_path)).select("page_id", "host", "path", "rule", "verdict").collect()]
    want = plain_verdicts(pages, edges)
    assert sorted(got, key=str) == want and {"allow", "block"} == {r[4] for r in want if r[3] is None}
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    rows = db.execute(f"SELECT page_id, host, path, rule, verdict FROM ({url_filter.OP9_SQL})").fetchall()
    assert sorted(rows, key=str) == want


def test_plan_of_edges_stays_small(spark):
    pages = spark.createDataFrame([(1, "http://a.org", "")], "page_id long, url string, html string")
    for frame in (url_filter.page_edges(pages), url_filter.page_edges(pages).where("target <> ''").distinct()):
        assert len(frame._jdf.queryExecution().optimizedPlan().toString()) < 100_000


def test_rules_and_groups(spark):
    pages = [(1, "http://A.example.com/en/1", None), (2, "https://www.example.com/en/1", ""), (3, "http://b.org/x", "<link href='u'>"),
             (4, "http://c.org/y", '<link rel="canonical" href="http://b.org/x"><p>'), (5, "http://b.net/es/q?utm_source=f", None), (6, None, "x"),
             (7, "no address", None), (8, "http://c.org/y", None), (8, "http://c.org/y", None), (9, "ftp://x.net/es/#a", None),
             (10, "http://d.org/", '<meta http-equiv="refresh" content="0; url=http://b.net/es/q">'), (11, "http://", None), (12, "", None)]
    frame = spark.createDataFrame([(*p, "k", "r") for p in pages], "page_id long, url string, html string, key string, rule string")
    rules = spark.createDataFrame(list(url_filter.PAGE_RULES), "host string, path string, action string")
    redirects = spark.createDataFrame([("http://e.org/1", "http://b.net/es/q"), ("http://e.org/1", "http://b.org/x"), (None, "u")], "source string, target string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(frame, rules, redirects).collect()}
    assert got[1] == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert got[2] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert got[5] == ("b.net", "/es/q", "net/es/", "block")
    assert got[9] == ("x.net", "/es/", "net/es/", "block")
    # e.org/1 joins b.net/es/q (blocked), b.org/x and, over its canonical link, c.org/y; d.org/ refreshes to it.
    assert got[3][2:] == got[4][2:] == got[8][2:] == got[10][2:] == (None, "block")
    assert got[6] == got[7] == got[12] == ("", "", None, "allow")
    assert got[11] == ("", "", None, "allow")
    assert url_filter.judge_urls(frame, rules, redirects).count() == len(pages)
    assert url_filter.judge_urls(frame.limit(0), rules).count() == 0
    # An explicit allow in the group takes precedence for pages without a rule.
    allowed = rules.union(spark.createDataFrame([("b.org", "/x", "allow")], rules.schema))
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(frame, allowed, redirects).collect()}
    assert (got[4], got[5], got[3]) == ("allow", "block", "allow")


def test_components_equal_union_find(spark):
    rnd = random.Random(8)
    edges = [(rnd.randint(0, 400), rnd.randint(0, 400)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1040)] + [
        (2000, k) for k in range(2001, 2100)] + [(7, 7), (None, 3)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r["node"], r["component"]) for r in found} == {(x, root(x)) for x in parent}
    assert len(found) == len(parent)
