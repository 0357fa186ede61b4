"""Small fixtures: nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import base64
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetspark.llm import decontamination, near_dedup, packing, quality_classifier, quality_rules, sharding, substring_dedup, toxicity, warc
from fleetspark.llm.common import utf8_buffers
from fleetspark.llm.fm_index import FMIndex
from fleetspark.llm.html_extract import extract_text, main_text
from fleetspark.llm.suffixes import neighbour_lcp, suffix_array

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORD = r"[^ \t-\r]+"


def docs(spark, rows, clash=True):
    df = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOC)
    names = ("size", "id", "row", "bytes", "hit", "n_words", "kept", "rid", "doc", "shard", "bin", "score") if clash else ()
    return df.withColumns({c: F.lit("clash") for c in names})


def sample_rows(seed=0, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["é", "ÉA", "#x"]
    text = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    passage = text(70)
    rows = [(None, "null id text", "a"), (900, None, "a"), (901, "", None), (902, "one", "b"), (903, " \n\t ", "b"), (5, text(20), "a"), (5, "other text", "a")]
    long = text(9000)
    rows += [(910, long, "a"), (911, long, "a"), (911, long, "a")]
    for i in range(n):
        body = text(rng.randrange(30, 200))
        if i % 3 == 0:
            body = f"{body}\n{passage} {text(5)}"
        rows.append((100 + i, body, rng.choice("aab")))
        if i % 4 == 0:
            words = body.split()
            words[rng.randrange(len(words))] = "changed"
            rows.append((400 + i, " ".join(words), "a"))
    return rows


def test_shards(spark):
    rows = sample_rows()
    got = sharding.shard_by_bytes(docs(spark, rows), 7).collect()
    want = sorted(((i is not None, i or 0, len((t or "").encode()) + 16) for i, t, _ in rows))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r["size"]) for r in got) == want
    total, by = sum(r["size"] for r in got), Counter()
    for r in got:
        by[r["shard"]] += r["size"]
    largest = max(r["size"] for r in got)
    assert set(by) <= set(range(7)) and all(abs(v - total / 7) <= largest for v in by.values())
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    order = [r["shard"] for r in sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r["shard"], r["slot"]))]
    assert order == sorted(order)
    assert sharding.shard_by_bytes(docs(spark, []), 7).count() == 0


def brute_pack(items, capacity):
    """items: (size, source, cluster) in placing order -> bin of each."""
    bins, out = [], []
    for size, source, cluster in items:
        fits = [(b[0], k) for k, b in enumerate(bins) if b[0] >= size and source not in b[1] and (cluster is None or cluster not in b[2])]
        if fits:
            k = min(fits)[1]
        else:
            k = len(bins)
            bins.append([capacity, set(), set()])
        bins[k][0] -= size
        bins[k][1].add(source)
        bins[k][2].add(cluster)
        out.append(k)
    return out


def test_packing_is_best_fit_without_conflicts(spark):
    rows = sample_rows(1)
    frame = docs(spark, rows)
    got = packing.pack(frame, capacity=150, group_rows=10_000).collect()
    text = {}
    for i, t, s in rows:
        text.setdefault(i, []).append((t, s))
    assert sum(r.n_words for r in got) == sum(len(re.findall(WORD, t or "")) for _, t, _ in rows)
    fill = Counter()
    for r in got:
        fill[r.bin] += r.n_words
    assert max(fill.values()) <= 150
    single = {i: v[0] for i, v in text.items() if len(v) == 1 and i is not None}
    by_bin = {}
    for r in got:
        by_bin.setdefault(r.bin, []).append(r.doc_id)
    for ids in by_bin.values():
        known = [single[i] for i in ids if i in single]
        assert len({s for _, s in known}) == len(known) and len({t for t, _ in known if t is not None}) == len([t for t, _ in known if t is not None])
    one = [(i, t, s) for i, t, s in rows if i in single and len(re.findall(WORD, t or "")) <= 150]
    got = {r.doc_id: r.bin for r in packing.pack(docs(spark, one), capacity=150, group_rows=10_000).collect()}
    import zlib

    order = sorted(one, key=lambda x: (-len(re.findall(WORD, x[1] or "")), x[0], zlib.crc32((x[1] or "").encode())))
    want = brute_pack([(len(re.findall(WORD, t or "")), s, t) for _, t, s in order], 150)
    assert [got[i] for i, _, _ in order] == want
    assert packing.pack(docs(spark, [])).count() == 0


def test_packing_spreads_repeated_rows(spark):
    rows = [(None, "", "a")] * 600 + [(7, "one two", "b")] * 600 + [(None, "one two", f"s{k}") for k in range(600)]
    got = packing.pack(docs(spark, rows), capacity=150, group_rows=100, lot=8).collect()
    assert Counter((r.doc_id, r.n_words) for r in got) == {(None, 0): 600, (7, 2): 600, (None, 2): 600}
    sizes = Counter(r.packing_group for r in got)
    assert len(sizes) == 18 and max(sizes.values()) <= 250  # one group held 600 and more
    back = packing.pack(docs(spark, rows[::-1]).repartition(5), capacity=150, group_rows=100, lot=8).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, back))


def test_packing_keeps_near_copies_apart(spark):
    rng = random.Random(4)
    words = [f"n{k}" for k in range(60)]
    near = lambda: " ".join(["x" if k == cut else w for k, w in enumerate(words)])
    rows = [(None, " ".join(words), "none"), (None, " ".join(words[::-1]), "none2"), (30, "", "e"), (31, "", "f")]
    for k, cut in enumerate(rng.sample(range(5, 55), 8)):
        rows.append((k, near(), f"s{k}"))
    rows += [(100 + k, f"far{k} apart{k}", f"t{k}") for k in range(8)]
    frame = docs(spark, rows)
    got = packing.pack(frame, capacity=2048, clusters=packing.near_clusters(frame, 2, 80)).collect()
    long = [r.bin for r in got if r.n_words == 60 and (r.doc_id is not None)]
    assert len(long) == 8 == len(set(long)) and len(got) == len(rows)
    without = Counter(r.bin for r in got if r.doc_id is None)  # one of the two id-less ones is a near copy
    assert sum(b not in long for b in without) >= 1
    assert len({r.bin for r in got if r.n_words == 0}) == 2


def brute_components(rows, n, percent):
    sets, ids = [], []
    for i, t, _ in rows:
        w = re.findall(WORD, re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
        ids.append(i)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            linked = common and 100 * common >= percent * len(sets[a] | sets[b])
            if None not in (ids[a], ids[b]) and (linked or ids[a] == ids[b] and sets[a] and sets[b]):
                parent[find(a)] = find(b)
    out = []
    for k in range(len(rows)):
        same = [ids[j] for j in range(len(rows)) if find(j) == find(k) and ids[j] is not None]
        own = ids[k] if ids[k] is None or not sets[k] else min(same)
        out.append((ids[k], len(sets[k]), own, ids[k] is None or ids[k] == own))
    return out


@pytest.mark.parametrize("shingle, bucket", [(2, 2048), (5, 3)])
def test_near_duplicates_equal_brute_force(spark, shingle, bucket):
    rows = sample_rows(2)
    got = near_dedup.near_duplicates(docs(spark, rows), shingle, bucket=bucket).collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(brute_components(rows, shingle, 80), key=key)


def test_near_duplicates_of_nothing(spark):
    assert near_dedup.near_duplicates(docs(spark, [])).count() == 0
    got = near_dedup.near_duplicates(docs(spark, [(1, None, "a"), (2, "", "a")])).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_sketches_estimate_high_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    for share in (0.95, 0.8, 0.6):
        swap = int(round(1000 * (1 - share) / (1 + share)))
        b = np.concatenate((a[swap:], rng.integers(0, 1 << 63, swap, dtype=np.uint64)))
        both, counts = np.concatenate((np.sort(a), np.sort(b))), np.array([1000, 1000])
        s = near_dedup.odd_sketches(near_dedup.signatures(both, counts)).view(np.uint64)
        found = near_dedup.estimate(np.bitwise_count(s[:1] ^ s[1:]).sum(1))[0]
        assert abs(found - share) < 0.09
        if share >= 0.8:
            assert np.bitwise_count(s[:1] ^ s[1:]).sum() <= near_dedup.sketch_limit(0.8)


def brute_removed(rows, window):
    first = {}
    words = [re.findall(WORD, t or "") for _, t, _ in rows]
    for (i, _, _), w in zip(rows, words, strict=True):
        for k in range(len(w) - window + 1):
            if i is not None:
                g = tuple(w[k : k + window])
                first[g] = min(i, first.get(g, i))
    out = []
    for (i, _, _), w in zip(rows, words, strict=True):
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("hot, shard_words", [(1000, 250_000), (1, 500)])
def test_repeats_equal_brute_force(spark, hot, shard_words):
    rows = sample_rows(3) + [(700 + k, "x " * 120, "a") for k in range(3)]
    got = substring_dedup.remove_repeats(docs(spark, rows), hot=hot, shard_words=shard_words).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[3])
    assert sorted((tuple(r) for r in got), key=key) == sorted(brute_removed(rows, 50), key=key)
    assert substring_dedup.remove_repeats(docs(spark, [])).count() == 0


def test_repeated_rows_ask_for_their_spans_once(spark):
    passage = " ".join(f"u{k}" for k in range(80))
    rows = [(1, passage, "a"), (2, f"head {passage} tail", "a"), (3, f"{passage} end", "b"), (None, passage, "a")] + [(2, f"head {passage} tail", "a")] * 40
    frame = docs(spark, rows)
    for hot in (1000, 1):
        spans = {r.rid: r.spans for r in substring_dedup.repeated_spans(substring_dedup._ids(frame, "doc_id", "text"), hot=hot).collect()}
        assert len(spans) == 2 and all(len(s) == len(set(s)) for s in spans.values())
        got = substring_dedup.remove_repeats(frame, hot=hot).collect()
        assert sorted(map(tuple, got), key=str) == sorted(brute_removed(rows, 50), key=str)


def test_kept_text_is_unchanged_or_joined(spark):
    a = " ".join(f"u{k}" for k in range(60))
    got = {r.doc_id: r for r in substring_dedup.remove_repeats(docs(spark, [(1, f"{a}\nz", "a"), (2, f"p\n{a} q", "a"), (3, None, "a")]), keep_columns=("source",)).collect()}
    assert got[1].kept_text == f"{a}\nz" and got[2].kept_text == "p q" and got[3].kept_text is None


@pytest.mark.parametrize("seed", range(40))
def test_fm_index_finds_windows_of_other_texts(seed):
    rng = np.random.default_rng(seed)
    kinds, width = int(rng.integers(1, 6)), int(rng.integers(1, 9))
    texts = [rng.integers(0, kinds, rng.integers(1, 60)) for _ in range(8)]
    texts.append(np.arange(kinds))  # every symbol occurs
    flat, end = np.concatenate(texts), np.cumsum([len(t) for t in texts])
    values = rng.permutation(len(texts))
    index = FMIndex(flat, np.append(0, end[:-1]), kinds, width, values)
    known = {}
    for value, t in zip(values.tolist(), texts, strict=True):
        for i in range(len(t) - width + 1):
            known[tuple(t[i : i + width])] = min(value, known.get(tuple(t[i : i + width]), 99))
    query = rng.integers(-1, kinds, 400)
    found = index.windows(query, np.array([0, 150]), np.array([150, 400]))
    for i in range(400):
        w = tuple(query[i : i + width]) if i + width <= 400 and not i < 150 < i + width else None
        want = known.get(w)
        assert (found[i] < 0) if want is None else (found[i] >= 0 and index.least[found[i]] == want)


def test_suffix_array_and_lcp():
    rng = np.random.default_rng(6)
    for n in (1, 2, 50):
        t = np.append(rng.integers(0, 2, n), 9)
        sa, levels = suffix_array(t)
        tails = [tuple(t[i:]) for i in sa]
        assert tails == sorted(tails)
        lcp = neighbour_lcp(sa, levels)
        for k in range(1, len(sa)):
            same = 0
            while same < min(len(tails[k]), len(tails[k - 1])) and tails[k][same] == tails[k - 1][same]:
                same += 1
            assert lcp[k] == same


def test_quality_rules_equal_brute_force(spark):
    rng = random.Random(7)
    texts = [None, "", "a", "a a a a", "é b\né b\n\n \né b"] + [" ".join(rng.choice(["a", "b", "é", "#|", "c\n", "dd", "e"]) for _ in range(rng.randrange(120))) for _ in range(60)]
    texts += [" ".join(f"w{k}" for k in range(250)) * 1 + " " + " ".join(f"w{k}" for k in range(250)) + " " + " ".join(f"v{k}" for k in range(600))]
    got = {r.doc_id: r for r in quality_rules.quality_rules(docs(spark, [(k, t, "a") for k, t in enumerate(texts)])).collect()}
    for k, t in enumerate(texts):
        t = t or ""
        w = re.findall(WORD, t)

        def spans(n, w=w):
            seen = Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
            return len({p for i in range(len(w) - n + 1) if seen[tuple(w[i : i + n])] > 1 for p in range(i, i + n)})

        longest = 0
        while spans(longest + 1):
            longest += 1
        lines = [x for x in t.split("\n") if re.search(WORD, x)]
        failed = len(w) < 50 or 100 * spans(3) > 50 * len(w)
        kept = not failed and 100 * spans(10) <= 50 * len(w) and longest <= 200
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), spans(3), spans(10), longest, failed, kept)
        assert tuple(got[k])[1:] == want
    assert not got[len(texts) - 1].base_failed and not got[len(texts) - 1].kept
    assert quality_rules.quality_rules(docs(spark, [])).count() == 0


@pytest.mark.parametrize("block", [10_000, 4])
def test_contamination(spark, block):
    item = " ".join(f"q{k}" for k in range(15))
    bench = spark.createDataFrame([(1, item), (2, "Short Answer"), (10, "short answer"), (3, None), (4, "!!"), (None, "lonely words here")], "item_id long, text string")
    rows = [(1, f"pre {item.upper()}! post", "a"), (2, "a short-answer, " + "pad " * 60, "a"), (3, None, "a"), (4, "shorter answer", "a"), (5, "x lonely  words here", "a"), (6, "q1 " + item[3:], "a")]
    got = {r.doc_id: r for r in decontamination.contamination(docs(spark, rows), bench, spans=True, block_windows=block).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (got[1].n_words, got[1].n_hit, got[1].n_items, got[1].items_sha256, got[1].contaminated) == (17, 15, 1, sha("1"), True)
    assert [rows[0][1][s.lo : s.hi] for s in got[1].hit_spans] == [item.upper()]
    assert (got[2].n_hit, got[2].items_sha256, got[2].contaminated) == (2, sha("10,2"), False)
    assert (got[3].n_words, got[3].contaminated, got[4].n_hit) == (0, False, 0)
    assert (got[5].n_hit, got[5].n_items, got[5].items_sha256) == (3, 0, sha(""))
    assert got[6].n_hit == 14
    assert decontamination.contamination(docs(spark, rows), bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontamination.contamination(docs(spark, []), bench).count() == 0


def test_html():
    page = """<html><head><title>t</title></head><body><div id="header">Site</div><nav><a>n</a></nav><div class="wrap"><div class="post"><h1>T &amp; U</h1>
    <p>Hello, world, this is <b>te</b>xt<br>one<p>second&nbsp;par <a href=x>link</a><script>var a = "<p>no</p>";</script><ul><li>one<li>two</ul></div>
    <div class="sidebar"><ul><li><a>a</a></ul></div><div id="comments"><p>great, post, really, great, wow</p></div></div><form>x</form><footer>f</footer>"""
    assert main_text(page) == "T & U Hello, world, this is text one second par link one two"
    assert main_text(None) == main_text("") == main_text("<nav>x</nav>") == ""
    assert main_text("just text") == "just text" and main_text("<p>a<p>b") == "a b"
    two = "<article><section><p>one, two</p></section><section><p>three</p></section><div class='ad'>buy</div></article><aside><p>long, long, long</p></aside>"
    assert main_text(two) == "one, two three"


def test_html_marks_on_wrappers():
    body = "<h1>Head</h1><p>A first paragraph, long enough to count, of the article.</p><p>And a second one, which goes on, and on.</p>"
    text = "Head A first paragraph, long enough to count, of the article. And a second one, which goes on, and on."
    side = "<div class='sidebar'><ul><li><a>link one</a><li><a>link two</a></ul><p>About us.</p></div><div class='related'><a>more</a></div><div id='cookie-notice'><p>We use cookies.</p></div>"
    for mark in ("class='content has-sidebar'", "class='no-sidebar'", "class='nav-open'", "id='sticky-footer-wrap'", "class='hasSidebar'", "class='header-fixed'", "class='comments-open'"):
        for inner in (body, f"<div class='post'>{body}</div>", f"<article>{body}</article>", f"<main><div>{body}</div></main>"):
            assert main_text(f"<body><div {mark}>{inner}{side}</div><footer><p>foot</p></footer></body>") == text, (mark, inner)
            assert main_text(f"<body><div {mark}>{inner}</div>{side}</body>") == text, (mark, inner)
    # a short article in a marked wrapper beside more text
    assert main_text(f"<div class='page has-sidebar'><article>{body}</article></div><div class='sidebar'><p>{'Side matter, much of it. ' * 9}</p></div>") == text
    # comments longer than the post stay out, with and without article elements
    wow = "".join(f"<article class='comment-body'><p>Reader {i}, says a lot, and more, of this and that.</p></article>" for i in range(9))
    for comments in (wow, wow.replace("article", "div")):
        assert main_text(f"<div class='post'>{body}</div><div id='comments'>{comments}</div>") == text
        assert main_text(f"<div id='comments'>{comments}</div><div class='has-sidebar'>{body}</div>") == text
    # passages of the article with an ambiguous class stay, short and link-heavy ones go
    for word in ("notice", "alert alert-info", "related", "share"):
        more = f"<p class='{word}'>Do take note of this passage, which the author wrote.</p>"
        for page in (f"<article>{body}{more}</article>", f"<div class='post'>{body}{more}</div>"):
            assert main_text(page) == f"{text} Do take note of this passage, which the author wrote."
        assert main_text(f"<article>{body}<p class='{word}'>Tell all</p><div class='{word}'><a>{'other articles ' * 9}</a></div></article>") == text
    assert main_text(f"<article>{body}<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds.</p></article>") == f"{text} So x=2 holds."
    assert main_text("<div class='widget'>all there is</div>") == "all there is"


def test_html_rows(spark):
    df = spark.createDataFrame([(1, "u", "<p>a&lt;b"), (1, "u", "<p>a&lt;b"), (None, None, None)], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    assert sorted(map(tuple, extract_text(df, keep_columns=("url",)).collect()), key=str) == [(1, "u", "a<b", 3), (1, "u", "a<b", 3), (None, None, "", 0)]
    assert extract_text(df.limit(0)).count() == 0


def test_archives(spark, tmp_path):
    rows = [(1, "http://a", "same"), (7, "http://b c\r\nX: y", "same"), (3, None, "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n"), (4, "u", ""), (5, "u", None), (6, "u", "é" * 2000), (None, "u", "same"), (8, "u", "twice"), (8, "u", "twice")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"digest": F.lit(1), "page": F.lit(2)})
    got = {}
    path = str(tmp_path / "warc")
    warc.write_archives(df, path, archive_bytes=1000)
    back = warc.resolve_revisits(warc.read_archives(spark, path, payloads=True)).collect()
    for r in back:
        got.setdefault(r.page, []).append(r)
    assert len(back) == len(rows)
    for i, _, html in rows:
        for r in got[i]:
            data = (html or "").encode()
            assert (r.payload, r.payload_bytes, r.digest) == (html or "", len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
    assert (got[1][0].record_type, got[1][0].refers_to, got[7][0].record_type, got[7][0].refers_to) == ("revisit", 7, "response", None)
    assert (got[4][0].refers_to, got[5][0].record_type, got[None][0].record_type) == (5, "response", "response")
    assert [r.record_type for r in got[8]] == ["response", "response"]
    assert warc.round_trip(df.limit(0)).count() == 0


def labelled(spark, kind):
    rng = random.Random(kind)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    rows, labels = [], []
    for i in range(400):
        bad = i % 2
        text = [rng.choice(words) for _ in range(rng.randrange(20, 60))]
        if bad:
            text = [w + rng.choice("###|||") for w in text] if kind == "quality" else [*text, *["rottenword" + rng.choice("abcdef")] * 3]
        rows.append((i, " ".join(text), "a"))
        labels.append((i, 1 - bad if kind == "quality" else bad))
    rows += [(1000, None, "a"), (1001, "", "a"), (None, "alpha beta", "a"), (7, "alpha", "a")]
    return docs(spark, rows), spark.createDataFrame(labels + labels[:3], f"doc_id long, {kind} int")


@pytest.mark.parametrize("kind, score", [("quality", quality_classifier.score_quality), ("toxic", toxicity.score_toxicity)])
def test_classifiers_hold_out(spark, kind, score):
    frame, labels = labelled(spark, kind)
    got = score(frame, labels).join(labels.distinct(), "doc_id", "left").collect()
    assert len(got) == 404 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    import zlib

    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out and r[kind] is not None and r.doc_id != 7]
    assert np.mean([r.predicted == r[kind] for r in held]) > 0.95
    assert score(frame.limit(0), labels).count() == 0
    assert {r.score for r in score(frame.limit(3), labels.limit(0)).collect()} == {0.0}


def test_misspelt_words_share_vectors():
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    text = lambda: [rng.choice(words) for _ in range(40)]
    texts = [" ".join([*text(), *(["disgusting"] * (k % 2) * 3)]) for k in range(200)]
    model = toxicity.train(texts, np.arange(200) % 2)
    z = toxicity.logits([" ".join([*text(), "disgustng", "disgussting", "disgustin"]), " ".join(text())], *model)
    assert z[0] > z[1] + 1


def test_word_spans_stay_in_rows():
    from fleetspark.llm import tokens

    texts = ["ab", "cd ", None, "", " ef\xa0g", "h" * 10]
    w = tokens.words(*utf8_buffers(pa.array(texts)))
    assert w.doc.tolist() == [0, 1, 4, 5] and np.diff(w.offsets).tolist() == [1, 1, 0, 0, 1, 1]
    old, tokens.BLOCK = tokens.BLOCK, 4
    try:
        assert (tokens.words(*utf8_buffers(pa.array(texts))).hash == w.hash).all()
    finally:
        tokens.BLOCK = old


def test_rare_toxic_words_keep_a_vector():
    rng = random.Random(9)
    texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(30)) for _ in range(1600)]
    for k in range(6):  # under a 200th of the texts
        texts[k] += " zorblagt" * 4
    labels = np.array([k < 6 or k % 5 == 0 for k in range(1600)], np.int64)
    scores, bias = toxicity.train(texts, labels)
    _, buckets = toxicity.subwords(["zorblagt"])
    assert np.count_nonzero(scores[buckets]) == len(buckets)
    clean = texts[1001]
    assert toxicity.logits([f"{clean} zorblagt zorblagt"], scores, bias)[0] > toxicity.logits([clean], scores, bias)[0]


def test_a_shard_searches_later_segments_among_earlier_ones():
    rng = np.random.default_rng(9)
    a, b, c = (rng.integers(0, 1 << 60, n).astype(np.uint64) for n in (90, 120, 80))
    b[20:75] = a[30:85]  # 55 words of document 1, so six windows
    rows = [(1, True, False, a), (5, True, True, b), (5, True, True, b[:60]), (7, False, True, c), (9, False, True, b), (9, False, True, c)]
    shard = pa.table({
        "doc": pa.array([d for d, *_ in rows], pa.int64()), "anchor": pa.array([3] * len(rows), pa.int64()), "segment": pa.array(range(len(rows)), pa.int64()),
        "indexed": [i for _, i, _, _ in rows], "streamed": [s for *_, s, _ in rows], "words": pa.array([w.tobytes() for *_, w in rows], pa.binary()),
    })
    got = sorted(tuple(r.values()) for r in substring_dedup.search_shard(shard, 50).to_pylist())
    assert got == [(3, 1, 5, 20, 26), (3, 4, 9, 0, 71)]
    assert substring_dedup.search_shard(shard.slice(3, 2), 50).num_rows == 0
