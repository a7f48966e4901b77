"""The ten operators against brute force, round trips or held-out labels, with awkward rows."""

import hashlib
import json
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortlake.llm import ann, bpe, decontaminate, html_extract, language, minhash, quality, sharding, substring, url_filter
from cohortlake.llm.components import components
from cohortlake.llm.queries import fold, vocabulary
from cohortlake.llm.textcore import normal, spans, word_hashes

DATA = "/root/testdata/sf0.001"
AWKWARD = [
    (1, None), (2, ""), (3, "  \t\n "), (4, "one"), (5, "one"), (6, "two words"), (7, "Two WORDS"), (None, "no id here at all, my friend"),
    (8, "été ÉTÉ naïve straße"), (9, "x" * 5000), (10, " ".join(["same"] * 200)), (11, "a b c d e f g"), (11, "a b c d e f g"),
    (12, "\x0b\x0cvertical\x1cseparators here\u00a0too\u2003wide"), (13, "42 !!! ???"),
]
SCHEMA = "doc_id long, text string, id string, hash int, kept boolean, size string, v int, ids int, n long"


@pytest.fixture(scope="module")
def docs(spark):
    rnd = np.random.default_rng(1)
    words = [f"w{k}" for k in range(3000)]
    rows = list(AWKWARD)
    base = [list(rnd.choice(words, int(rnd.integers(40, 160)))) for _ in range(25)]
    shared = list(rnd.choice(words, 60))
    for k, b in enumerate(base):
        rows.append((100 + 10 * k, " ".join(b)))
        for c in range(int(rnd.integers(0, 5))):
            copy = list(b)
            for _ in range(int(rnd.integers(0, 6))):
                copy[int(rnd.integers(len(copy)))] = "edit" + str(int(rnd.integers(1000)))
            rows.append((101 + 10 * k + c, " ".join(copy)))
        if k % 4 == 0:
            rows.append((900 + k, " ".join([*rnd.choice(words, 30), *shared, *rnd.choice(words, 20)])))
    long = list(rnd.choice(words, 30_000))
    rows += [(2000, " ".join(long)), (2001, " ".join(long[5000:5200]))]
    return spark.createDataFrame([(i, t, "x", 1, True, "s", 1, 1, 1) for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def split(t):
    return (t or "").encode().split()


def test_substring_matches_brute_force(docs, empty):
    for width in (35, 20):
        rows = texts(docs)
        count = Counter(tuple(w[k : k + width]) for _, t in rows for w in [split(t)] for k in range(len(w) - width + 1))
        want = []
        for i, t in rows:
            w, gone = split(t), set()
            for k in range(len(w) - width + 1):
                if count[tuple(w[k : k + width])] > 1:
                    gone.update(range(k, k + width))
            want.append((str(i), len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
        out = substring.dedup_substrings(docs, width=width, cells=1 << 23)
        assert set(docs.columns) - {"kept"} <= set(out.columns)
        assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in out.collect()) == sorted(want)
    assert substring.dedup_substrings(empty).count() == 0


def test_substring_survives_a_full_sketch(docs):
    """With far too few cells every window goes to the exact pass; the result stays."""
    key = lambda df: sorted((str(r.doc_id), r.n_removed, r.kept) for r in df.collect())
    assert key(substring.dedup_substrings(docs, cells=1 << 10)) == key(substring.dedup_substrings(docs))


def test_representatives_lie_in_their_windows():
    h = np.arange(1, 1000, dtype=np.uint64)
    x, place = substring.representatives(h, 35)
    assert len(x) == len(h) - 34 and ((place >= np.arange(len(x))) & (place <= np.arange(len(x)) + 15)).all()
    same = substring.representatives(np.full(100, 7, np.uint64), 35)[1]
    assert (same == np.arange(66)).all()


def test_pieces_of_a_long_text_overlap(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(substring, "PIECE", 100)
    text = " ".join(f"t{k}" for k in range(1000))
    batch = pa.RecordBatch.from_arrays([pa.array([text, "a b c"])], names=["text"])
    starts = []
    for row, _, first, moved, words in substring._texts(batch, 0, 35):
        at = substring.window_starts(first, 35)
        starts += [(row, moved + int(k)) for k in at]
        for k, one, two in zip(at, *words.digests(at, 35)):
            want = hashlib.blake2b(" ".join(text.split()[moved + k : moved + k + 35]).encode(), digest_size=12).digest()
            assert int(one).to_bytes(8, "little") + int(two).to_bytes(4, "little") == want
    assert starts == [(0, k) for k in range(966)]


def thue_morse(bits: int) -> tuple[str, str]:
    """A word over two letters and its complement: the same value of any polynomial modulo 2**64, from 2**11 letters on."""
    word = "".join("ab"[bin(k).count("1") & 1] for k in range(1 << bits))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_made_to_collide_are_told_apart(spark):
    a, b = thue_morse(11)
    one, two = (np.frombuffer(x.encode(), np.uint8) for x in (a, b))
    h = [int(word_hashes(x, np.array([0]), np.array([2048]), key)[0]) for x in (one, two) for key in (0, 1)]
    assert len(set(h)) == 4
    around = lambda x: " ".join([*(f"w{k}" for k in range(17)), x, *(f"v{k}" for k in range(17))])
    rows = [(1, a), (2, b), (3, around(a)), (4, around(b)), (5, around(a)), (6, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 3, 6: 1}
    assert {r.doc_id: r.n_removed for r in substring.dedup_substrings(docs, cells=1 << 20).collect()} == {1: 0, 2: 0, 3: 35, 4: 0, 5: 35, 6: 0}


def test_normal_puts_one_space_between_words():
    texts = ["  a\t\nbc ", "", "d", "e  f", " \n"]
    buf, offsets = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *map(len, texts)])
    starts, ends, first = spans(buf, offsets)
    out, x, y = normal(buf, starts, ends)
    got = [bytes(out[x[i] : y[j - 1]]) if j > i else b"" for i, j in zip(first[:-1], first[1:])]
    assert got == [b"a bc", b"", b"d", b"e f", b""]


def test_minhash_matches_brute_force(docs, empty):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    sets = defaultdict(list)
    for i, t in texts(docs):
        w = (t or "").encode().translate(low).split()
        sets[i].append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set()))
    parent = {i: i for i in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(parent)
    for x in ids:
        for y in ids:
            if x < y and any(a and b and 100 * len(a & b) >= 75 * len(a | b) for a in sets[x] for b in sets[y]):
                a, b = find(x), find(y)
                parent[max(a, b)] = min(a, b)
    out = minhash.near_duplicates(docs).collect()
    assert len(out) == docs.count()
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == find(r.doc_id) and r.kept == (r.component_id == r.doc_id)
            assert r.n_shingles in {len(s) for s in sets[r.doc_id]}
    assert minhash.near_duplicates(empty).count() == 0


def test_minhash_second_phase_finds_links_past_the_pivot(spark):
    """A chain in which only neighbours are similar ends as one component."""
    words = [f"v{k}" for k in range(400)]
    rows = [(k, " ".join(words[6 * k : 6 * k + 100])) for k in range(30)]
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in out} == {0}


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 9), (5, 5), (3, 10), (20, 21), (21, 22), (22, 23), (23, 24)]
    got = {r.u: r.v for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {2: 1, 3: 1, 10: 1, 8: 7, 9: 7, 21: 20, 22: 20, 23: 20, 24: 20}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_hubs_match_union_find(spark):
    rnd = np.random.default_rng(3)
    links = [(0, int(x)) for x in rnd.integers(100, 900, 600)] + [(999, int(x)) for x in rnd.integers(100, 900, 300)]
    links += [(int(a), int(b)) for a, b in rnd.integers(1000, 1400, (250, 2))] + [(-k, -k - 1) for k in range(1, 30)]
    root = {x: x for pair in links for x in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {x: find(x) for x in root if find(x) != x}
    got = components(spark.createDataFrame(links, "a long, b long").repartition(4)).collect()
    assert len(got) == len(want) and {r.u: r.v for r in got} == want


def test_bpe_matches_the_library(docs, empty):
    tokenizers = pytest.importorskip("tokenizers")
    lib = tokenizers.Tokenizer.from_file(vocabulary())
    more = ["Hello  WORLD it's 123 é́ <|endoftext|>abc &&&", "ΟΔΟΣ Σ", "日本　語 ½²", "<|startoftext|><|endoftext|>", "the" * 2000]
    rows = docs.select("doc_id", "text").unionByName(docs.sparkSession.createDataFrame([(5000 + k, t) for k, t in enumerate(more)], "doc_id long, text string"))
    for r in bpe.encode_decode(rows, vocabulary()).collect():
        want = lib.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == want
        assert r.decoded == lib.decode(want, skip_special_tokens=False)
    assert bpe.encode_decode(empty, vocabulary()).count() == 0
    coded = bpe.encode_decode(rows, vocabulary())
    assert bpe.decode_ids(coded.withColumnRenamed("decoded", "was"), vocabulary()).where("was <> decoded").count() == 0


def test_url_filter(spark):
    urls = [None, "", "nothing", "http://example.com/en/x", "http://EXAMPLE.com/en", "https://www.example.com/en/a?b#c", "http://a.www.example.com/en/", "x://net/es/",
            "http://foo.net/fr/1", "http://foonet/es/", "http://org.example.org/net/es/", "http://x.com", "http://x.com?y/", "http://x.com/", "a://b://c.com/", "http://evil.org/a.com/b", "http://é.com/É\n/z"]
    rules = url_filter.RULES
    df = spark.createDataFrame([(k, u, "old") for k, u in enumerate(urls)], "page_id long, url string, verdict string")
    for r in url_filter.filter_urls(df).collect():
        u = urls[r.page_id]
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fit = [(len(h + p), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, verdict, rule = max(fit, default=(0, "allow", None))
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict), u
    many = [("block", f"h{k}.example", f"/p{k}/") for k in range(200)]
    out = url_filter.filter_urls(spark.createDataFrame([(k, f"http://a.h{k}.example/p{k}/q") for k in range(200)], "page_id long, url string"), rules=many).collect()
    assert all(r.rule == f"h{r.page_id}.example/p{r.page_id}/" for r in out)
    assert url_filter.filter_urls(df.limit(0)).count() == 0


def test_globs_against_fnmatch():
    from fnmatch import fnmatchcase

    globs = [b"*", b"a*b", b"**a", b"abc", b"a*b*c*", b""]
    strings = [b"", b"a", b"ab", b"abc", b"axxb", b"aabbcc", b"ba", b"cab"]
    offsets = np.cumsum([0, *map(len, strings)])
    got = url_filter.simulate(url_filter.compile_globs(globs), np.frombuffer(b"".join(strings), np.uint8), offsets)
    for i, s in enumerate(strings):
        assert [bool(x) for x in got[i]] == [fnmatchcase(s.decode(), g.decode()) for g in globs]


def test_sharding(docs, empty):
    out = sharding.assign_shards(docs).collect()
    rows = Counter((str(i), t) for i, t in texts(docs))
    assert len(out) == docs.count()
    load, slots, where = Counter(), defaultdict(list), {}
    of = defaultdict(set)
    for i, t in texts(docs):
        of[str(i)].add((len((t or "").encode()) + 1, None if t is None else zlib.crc32(t.encode())))
    for r in out:
        assert (r.size, r.text_crc32) in of[str(r.doc_id)] and r.law == "bytes" and r.grown_shard is None
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert where.setdefault((r.size, r.text_crc32), r.shard) == r.shard
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and rows
    assert sharding.assign_shards(empty).count() == 0


def test_longest_first_balances_and_matches_plain_heap():
    import heapq

    rnd = np.random.default_rng(2)
    sizes = rnd.integers(1, 10_000, 500).tolist()
    heap, want = [(0, s) for s in range(8)], Counter()
    for s in sorted(sizes, reverse=True):
        x, k = heapq.heappop(heap)
        heapq.heappush(heap, (x + s, k))
        want[k] += s
    got = Counter()
    for k, runs in sharding.longest_first([(float(s), 1, i) for i, s in enumerate(sizes)], 8).items():
        got[runs[0][0]] += sizes[k]
    assert sorted(got.values()) == sorted(want.values())
    runs = sharding.longest_first([(100.0, 10, "a"), (3.0, 10_000, "b")], 8)
    assert sum(n for _, n in runs["b"]) == 10_000
    load = Counter()
    for key, size in (("a", 100), ("b", 3)):
        for s, n in runs[key]:
            load[s] += n * size
    assert max(load.values()) - min(load.values()) <= 6


def test_language(spark, docs, empty):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(d.where(fold() != 2))
    held = language.identify(d.where(fold() == 2), model)
    n, right = held.count(), held.where("lang_pred = lang").count()
    assert right >= 0.98 * n
    for r in language.identify(docs, model).collect():
        if not any(map(str.isalpha, r.text or "")):
            assert (r.lang_pred, r.score, r.languages) == ("und", 0.0, [])
        else:
            assert r.lang_pred in model.languages and 0 <= r.score <= 1
    a, b = (d.where(f"lang = '{x}' AND n_chars > 1500").select("text").first().text[:1500] for x in ("en", "de"))
    both = language.identify(spark.createDataFrame([(a + " " + b,)], "text string"), model).first()
    assert set(both.languages) == {"en", "de"} and abs(both.score - 0.5) < 0.15
    assert language.identify(empty, model).count() == 0
    none = language.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in language.identify(docs, none).collect()} == {"und"}


def plain_mixture(model, grams):
    """Shares and gain of one text, entry by entry."""
    count = Counter(int(g) for g in grams)
    every, n = range(len(model.languages)), len(grams)

    def em(pi, rounds):
        for _ in range(rounds):
            new = [0.0] * len(pi)
            for g, c in count.items():
                r = [pi[k] * np.exp(model.logp[g, k]) for k in every]
                new = [x + c * y / sum(r) for x, y in zip(new, r)]
            pi = [x / n for x in new]
        return pi, sum(c * np.log(sum(pi[k] * np.exp(model.logp[g, k]) for k in every)) for g, c in count.items())

    pi, _ = em(list(model.prior), language.ROUNDS)
    order, best = sorted(every, key=lambda k: -pi[k]), None
    for size in range(1, len(pi) + 1):
        if size > 1 and pi[order[size - 1]] < language.LEAST_SHARE:
            break
        start = [max(pi[k], 1e-9) if k in order[:size] else 0.0 for k in every]
        start, ll = em([x / sum(start) for x in start], 0 if size == 1 else language.ROUNDS // 2)
        value = ll / language.OVERLAP - (size - 1) / 2 * np.log(max(n / language.OVERLAP, 2))
        if best is None or value > best[0]:
            best = value, start, (ll / n + np.log(language.GRAMS)) / np.log(2)
    return best[1:]


def test_mixture_matches_brute_force(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.fit(d)
    some = {x: d.where(f"lang = '{x}' AND n_chars > 300").orderBy("doc_id").first().text[:300] for x in model.languages}
    a, b = model.languages[:2]
    mixed = [*some.values(), some[a] + " " + some[b], some[a][:30], "x", "né"]
    raw = [t.encode() for t in mixed]
    keys = language.gram_keys(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in raw])]))
    shares, gain = language.solve(model, keys, len(raw))
    for k in range(len(raw)):
        want, bits = plain_mixture(model, keys[keys // language.GRAMS == k] % language.GRAMS)
        assert np.allclose(shares[k], want, atol=1e-9) and abs(gain[k] - bits) < 1e-9


def test_rare_languages_are_learned(spark):
    rows = [(k, f"the plain words of row {k}", "en") for k in range(4000)] + [(9000 + k, "ein paar andere worte", "de") for k in range(3)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows=500)
    assert model.languages == ["de", "en"]
    assert np.allclose(model.prior, [4 / 4005, 4001 / 4005])


def test_html_extraction(spark):
    field = html_extract.default_field()
    bad = total = 0
    for page, labels in html_extract.labelled_pages(100, seed=1234):
        got = field.decode(page)
        bad += sum(x != y for x, y in zip(got, labels))
        total += len(labels)
    assert bad <= 0.005 * total
    page = (
        "<html><head><title>T</title><script>var a='<p>no</p>';</script></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav>"
        "<div class=cookie-notice>We use cookies.</div><article><h1>A &amp; B</h1><p>First\n  para&eacute; <b>bold</b>.<p>Second one &#8212; ok.</p></article>"
        "<section id=comments><p>Nice post, I liked it.</p></section><footer>&copy; x.com</footer>"
    )
    df = spark.createDataFrame([(1, page, "x"), (2, None, "x"), (3, "", "x"), (4, "plain < text", "x"), (1, page, "x")], "page_id long, html string, text string")
    got = sorted((r.page_id, r.text) for r in html_extract.extract_text(df).collect())
    want = "A & B\nFirst paraé bold.\nSecond one — ok."
    assert got[:4] == [(1, want), (1, want), (2, ""), (3, "")]
    assert html_extract.extract_text(df.limit(0)).count() == 0


def test_html_on_pages(spark):
    import html as h

    for r in html_extract.extract_text(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).collect():
        a = r.html[r.html.index("<article>") + 9 : r.html.index("</article>")]
        parts = (" ".join(h.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?p>|</?h1>", a))
        assert r.text == "\n".join(x for x in parts if x)


def test_nearest(spark):
    rnd = np.random.default_rng(3)
    x = rnd.standard_normal((1500, 16)).astype(np.float32)
    x[100:700] = x[100]  # a third are one vector
    rows = [(k, v.tolist(), 1) for k, v in enumerate(x)]
    rows += [(2000, None, 1), (2020, [0.0] * 16, 1), (2040, [float("nan")] + [1.0] * 15, 1), (2060, [float("inf")] + [1.0] * 15, 1), (2080, [None] + [1.0] * 15, 1), (None, [1.0] * 16, 1), rows[40]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = defaultdict(list)
    for r in ann.nearest(df).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, 1500, 20))
    y, hit = x.astype(np.float64), 0
    for q, found in got.items():
        found.sort()
        s = y @ y[q]
        assert [k for k, _, _ in found] == list(range(1, 21)) and all(abs(v - s[i]) < 1e-9 for _, i, v in found)
        best = [i for i in np.lexsort((np.arange(1500), -s)) if i != q][:20]
        hit += len(set(best) & {i for _, i, _ in found})
        if 100 <= q < 700 and s[100] == s.max():
            assert [i for _, i, _ in found] == [i for i in range(100, 700) if i != q][:20]
    assert hit >= 0.95 * 20 * len(got)
    few = ann.nearest(df.where("vec_id < 5")).collect()
    assert [(r.query_id, r.rank) for r in sorted(few)] == [(0, k) for k in range(1, 5)]
    assert ann.nearest(df.where("vec_id < 0")).count() == 0


def test_quality(spark, docs, empty):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(d.where("doc_id % 5 <> 0"), labels)
    out = quality.score_quality(d, labels, F.col("source"), F.concat_ws("/", "source", "lang"), model=model).join(labels, "doc_id")
    held = out.where("doc_id % 5 = 0")
    assert held.where("(quality = 1) = (p_quality >= 0.5)").count() >= 0.93 * held.count()
    assert out.where("p_quality IS NULL OR p_toxic IS NULL OR isnan(p_quality)").count() == 0
    got = quality.score_quality(docs, labels, F.lit(None), F.col("text"), model=model)
    assert got.count() == docs.count() and got.where("keep IS NULL").count() == 0
    nothing = quality.fit(docs, labels.limit(0))
    assert quality.score_quality(docs, labels, F.lit("h"), F.lit("p"), model=nothing).where("keep IS NULL").count() == 0
    assert quality.score_quality(empty, labels, F.lit("h"), F.lit("p"), model=model).count() == 0


def test_sparse_sites_lean_on_their_host(spark):
    """The path rate of a site with one document stays near its host's, that of a large one near its own."""
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(200)], "doc_id long, quality int, toxic int")
    good, junk = "Plain sentences of good prose follow one another here.", "BUY!! NOW!! $$$ ### BUY!!"
    rows = [(k, f"{good} {k}" if k % 2 else f"{junk} {k}", "big", "a" if k % 2 else "b") for k in range(200)] + [(500, junk, "big", "lone")]
    d = spark.createDataFrame(rows, "doc_id long, text string, host string, path string")
    got = {r.path: r for r in quality.score_quality(d, labels, F.col("host"), F.col("path")).collect()}
    assert got["a"].path_quality > 0.8 > 0.5 > 0.2 > got["b"].path_quality
    assert got["b"].path_quality < got["lone"].path_quality <= got["lone"].host_quality


def test_posterior_matches_brute_force(spark):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    got = quality.score_quality(d, labels, F.col("source"), F.concat_ws("/", "source", "lang")).toPandas()

    def strength(n, s, m):
        between = max(0.0, ((n * (s / n - m) ** 2).sum() - (m * (1 - m)).sum()) / (n * m * (1 - m)).sum())
        return min(quality.MOST_STRENGTH, max(quality.LEAST_STRENGTH, (1 - between) / between if between > 0 else quality.MOST_STRENGTH))

    def logit(p):
        p = np.clip(p, 1e-9, 1 - 1e-9)
        return np.log(p / (1 - p))

    for t in quality.TARGETS:
        e = got[f"e_{t}"]
        mean = e.mean()
        by_host, by_path = e.groupby(got["host"]), e.groupby(got["path"])
        hn, hs = by_host.count(), by_host.sum()
        kh = strength(hn, hs, pd.Series(mean, hn.index))
        rate = (hs + kh * mean) / (hn + kh)
        pn, ps = by_path.count(), by_path.sum()
        kp = strength(pn, ps, rate[got.groupby("path")["host"].first()].set_axis(pn.index))
        host = (hs[got["host"]].to_numpy() - e + kh * mean) / (hn[got["host"]].to_numpy() - 1 + kh)
        path = (ps[got["path"]].to_numpy() - e + kp * host) / (pn[got["path"]].to_numpy() - 1 + kp)
        want = 1 / (1 + np.exp(logit(mean) - logit(e) - logit(path)))
        assert np.abs(want - got[f"p_{t}"]).max() < 1e-7


def test_decontamination(spark, empty):
    d, b = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    words = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    rows = [(r.doc_id, " " + " ".join(words(r.text)) + " ") for r in d.collect()]
    want = {(i, k.item_id) for k in b.collect() for i, t in rows if " " + " ".join(words(k.text)) + " " in t}
    got = {(r.id, r.item_id) for r in decontaminate.find_leaks(d, b).collect()}
    assert len(want & got) >= 0.97 * len(want) and len(got - want) <= 0.02 * len(want) + 1
    left = decontaminate.decontaminate(d, b)
    assert left.columns == d.columns and left.count() == d.count() - len({i for i, _ in got})
    # A paraphrase: some words changed, the answer kept.
    item = next(k for k in b.collect() if len(k.text.split()) > 30)
    w = item.text.split()
    para = [x if k % 4 or k > len(w) - 6 else "changed" for k, x in enumerate(w)]
    extra = spark.createDataFrame([(777_001, " ".join(para), "en", "s", 1), (None, item.text, "en", "s", 1), (777_002, None, "en", "s", 1), (777_003, "", "en", "s", 1)], d.schema)
    found = {(r.id, r.item_id) for r in decontaminate.find_leaks(d.unionByName(extra), b).collect()}
    assert {(777_001, item.item_id), (None, item.item_id)} <= found and not {777_002, 777_003} & {i for i, _ in found}
    assert decontaminate.find_leaks(d, b.limit(0)).count() == 0 and decontaminate.find_leaks(empty, b).count() == 0


def test_every_verbatim_leak_is_found_among_other_benchmark_words(spark):
    rnd = np.random.default_rng(8)
    vocabulary = [f"w{k}" for k in range(3000)]
    items = [[vocabulary[k] for k in rnd.integers(0, 3000, n)] for n in rnd.choice([3, 17, 33], 60)]
    b = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    # A word of another item, many times over, fills the passage before and after the leak.
    rows = [(k, " ".join([items[k - 1][0]] * 90 + w + [items[k - 2][0]] * 90)) for k, w in enumerate(items)]
    rows += [(1000 + k, " ".join(vocabulary[x] for x in rnd.integers(0, 3000, 200))) for k in range(60)]
    found = {(r.id, r.item_id) for r in decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), b).collect()}
    assert {(k, k) for k in range(len(items))} <= found and not {i for i, _ in found if i >= 1000}


def test_lcs():
    def plain(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    rnd = np.random.default_rng(4)
    for _ in range(200):
        a, b = rnd.integers(1, 6, rnd.integers(1, 30)).tolist(), rnd.integers(1, 8, rnd.integers(0, 40)).tolist()
        places = {x: sum(1 << k for k, y in enumerate(a) if y == x) for x in set(a)}
        assert decontaminate.lcs(places, (1 << len(a)) - 1, b) == plain(a, b)


def test_pipeline(spark):
    import corpus_pipeline

    d = spark.read.parquet(f"{DATA}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    kept = stage["near_dedup"](spark, d, DATA)
    groups = minhash.near_duplicates(d)
    assert {r.doc_id for r in kept.collect()} == {r.component_id for r in groups.collect()}
    assert all(f(spark, d, DATA).columns == d.columns for k, f in corpus_pipeline.STAGES[:-1])
    out = corpus_pipeline.run(spark, DATA)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 0 < out.count() <= kept.count() and out.count() == out.select("doc_id").distinct().count()


@pytest.mark.parametrize("order", [(0, 1, 0), (1, 0, 1)])
def test_bpe_of_long_texts_with_many_words(monkeypatch, order):
    from tokenizers import Tokenizer

    monkeypatch.setattr(bpe, "WORDS_KEPT", 3000)
    texts = [" ".join([*(f"q{k}" for k in range(5000)), "common", "words"]), " ".join(["words", *(f"z{k}x" for k in range(5500)), "common"])]
    codec = bpe.Codec(json.loads(Path(vocabulary()).read_text()))
    library = Tokenizer.from_file(vocabulary())
    for k in order:
        ids, shown = codec.encode([texts[k]])[0]
        want = library.encode(texts[k], add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want and shown.decode() == library.decode(want, skip_special_tokens=False)
    assert len(codec.ids) < 3000 + 11_000
