"""Each operator against brute force on small tables with nulls, empty texts, ties and repeats."""

from __future__ import annotations

import hashlib
import html as decoder
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from slipmatch.llm import decontaminate, html, language, mixing, near_dedup, neighbours, repeats, slots, tokens
from slipmatch.llm.queries import RULES
from slipmatch.llm.url_filter import judge_urls, with_membership

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "en", "o"]) + str(rng.randrange(30)) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Texts with copies, near copies, shared passages, and all kinds of odd ones."""
    rng = random.Random(5)
    base = [prose(rng, rng.randrange(20, 90)) for _ in range(12)]
    texts = [*base, base[0], base[0], base[3]]
    for text in base[:4] * 2:
        words = text.split(" ")
        words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    passage = prose(rng, 25)
    texts += [prose(rng, 10) + " " + passage + " " + prose(rng, 10) for _ in range(3)]
    texts += [None, "", " \n\t ", "one", "ONE", "one two", "Café ünïcode", passage * 2, "ab" * 150, "ab" * 120, prose(rng, 4000)]
    rng.shuffle(texts)
    return [(i, t, None, None if i % 7 == 0 else f"s{i % 4}") for i, t in enumerate(texts)]


def shingled(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def test_url_rules_and_cascade(make):
    urls = [None, "", "no host", "HTTP://A.Example.ORG/es/x?q", "x://example.org/en/1#t", "x://badexample.org/en/1",
            "x://a.com/fr/1", "x://a.com/de", "x://a.com/de/", "x://net", "x://listed.net/a", "x://com/fr/"]
    pages = make([(i, u) for i, u in enumerate(urls + urls)], "page_id long, url string, host string, extra int")
    found = {r["page_id"] % len(urls): (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(pages, RULES, F.col("host") == "listed.net").collect()}
    assert found == {
        0: ("", "", None, "allow"), 1: ("", "", None, "allow"), 2: ("", "", None, "allow"),
        3: ("a.example.org", "/es/x", "example.org/es/", "block"), 4: ("example.org", "/en/1", "example.org/en/1", "block"),
        5: ("badexample.org", "/en/1", "org/", "allow"), 6: ("a.com", "/fr/1", "com/fr/", "allow"),
        7: ("a.com", "/de", None, "allow"), 8: ("a.com", "/de/", "com/de/", "block"), 9: ("net", "", None, "allow"),
        10: ("listed.net", "/a", None, "block"), 11: ("com", "/fr/", "com/fr/", "allow"),
    }
    keys = pages.sparkSession.range(20_000).select(F.col("id").cast("string").alias("key"))
    listed = F.col("key").cast("long") % 3 == 0
    assert with_membership(keys, "key", listed).where(F.col("listed") != listed).count() == 0
    assert judge_urls(pages.limit(0), RULES, F.lit(True)).count() == 0


def test_slots(make, corpus, tmp_path):
    found = slots.shard(make(corpus + corpus[:3]), 4, f"file://{tmp_path}/m").toPandas()
    text = {i: t for i, t, *_ in corpus}
    for r in found.to_dict("records"):
        raw = (text[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
    for _, own in found.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    assert slots.shard(make([]), 4, f"file://{tmp_path}/n").count() == 0
    sizes = {s: s % 17 + 1 for s in range(400)}
    old = slots.first_map(sizes, 8, 400)
    new = slots.rebalanced(old, sizes, 9)
    held = Counter()
    for s, shard in new.items():
        held[shard] += sizes[s]
    assert max(held.values()) - min(held.values()) <= 17
    # Little more moves than the new shard needs.
    assert sum(sizes[s] for s in new if new[s] != old[s]) <= 1.1 * sum(sizes.values()) / 9


def test_mixing(make, corpus):
    rows = mixing.mixed(make(corpus), block=4).select("document.doc_id", "document.source", "size", "source_size", "target", "taken").collect()
    count = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in corpus}
    assert {r["doc_id"]: r["size"] for r in rows} == count
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    total = Counter()
    for r in rows:
        total[r["source"]] += r["taken"]
    target = {r["source"]: r["target"] for r in rows}
    assert all(abs(total[s] - target[s]) <= 8 for s in target)
    assert abs(sum(target.values()) - 1.5 * sum(count.values())) < 1e-6
    drawn = mixing.drawn(make(corpus), block=4).collect()
    assert sum(len((r["text"]).split()) for r in drawn) == sum(total.values())
    assert mixing.mixed(make([])).count() == 0


def test_apportionment_is_by_highest_quotients():
    votes = {"a": 53.0, "b": 24.0, "c": 23.0, None: 5.5}
    most = dict.fromkeys(votes, 1000) | {"a": 40}
    got = dict.fromkeys(votes, 0)
    for n in range(1, 90):
        best = max((s for s in mixing.in_order(votes) if got[s] < most[s]), key=lambda s: votes[s] / (2 * got[s] + 1))
        got[best] += 1
        assert mixing.quotas(votes, most, n) == got
    shards = mixing.shard_quotas(votes, most, 89, 7)
    assert {s: sum(q[s] for q in shards) for s in votes} == got


def test_near_duplicates(make, corpus):
    found = {r["doc_id"]: r for r in near_dedup.groups(make(corpus), 85).collect()}
    sets = {i: shingled(t) for i, t, *_ in corpus}
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if sets[a] and 100 * both >= 85 * len(sets[a] | sets[b]) and label[a] < label[b]:
                    label[b], changed = label[a], True
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in found.items()} == {
        i: (len(sets[i]), label[i], label[i] == i) for i in sets
    }
    assert near_dedup.groups(make([]), 85).count() == 0
    assert near_dedup.groups(make([(None, "a b c d e f"), (None, None)]), 85).count() == 2


def test_components_that_share_buckets(make):
    """Families a little too far apart to be linked meet in the same buckets, and lose no link."""
    rng = random.Random(11)
    base = prose(rng, 120).split(" ")
    texts = []
    for family in range(10):
        # Two changed words far apart: two families have a similarity of about 0.7.
        own = base[:]
        own[10 + family], own[60 + 5 * family] = f"f{family}", f"g{family}"
        for copy in range(6):
            near = own[:]
            near[-1 - copy % 3] = f"h{copy}"
            texts.append(" ".join(near))
    sets = [shingled(t) for t in texts]
    parent = list(range(len(texts)))

    def top(x):
        return x if parent[x] == x else top(parent[x])

    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    expected = {i: top(i) for i in range(len(texts))}
    assert 1 < len(set(expected.values())) < len(texts)
    found = near_dedup.groups(make(list(enumerate(texts))), 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == expected


def test_near_duplicates_of_ids_with_several_texts(make):
    """All texts of an id are looked at, and link what they are near to."""
    rng = random.Random(17)
    texts = [prose(rng, 60) for _ in range(6)]
    near = [t + " end" for t in texts]
    rows = [(50, texts[0]), (50, texts[1]), (50, texts[2]), (7, near[0]), (3, near[1]), (60, near[2]), (50, None),
            (9, texts[3]), (9, texts[4]), (9, texts[3]), (12, near[4]), (11, near[3]), (13, texts[5])]
    want = {50: 3, 7: 3, 3: 3, 60: 3, 9: 9, 12: 9, 11: 9, 13: 13}
    for some in (rows, rows[::-1]):
        found = near_dedup.groups(make(some), 85).where("n_shingles > 0").collect()
        assert len(found) == 12 and all(r["component_id"] == want[r["doc_id"]] for r in found)


def test_repeats(make, corpus):
    found = {r["doc_id"]: r for r in repeats.without_repeats(make(corpus)).collect()}
    seen = set()
    for i, text, *_ in corpus:
        raw = (text or "").encode()
        cut = np.zeros(len(raw), dtype=bool)
        for p in range(len(raw) - 99):
            cut[p : p + 100] |= raw[p : p + 100] in seen
            seen.add(raw[p : p + 100])
        kept = bytes(b for b, c in zip(raw, cut, strict=True) if not c)
        spans = sum(c and (p == 0 or not cut[p - 1]) for p, c in enumerate(cut))
        r = found[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (
            len(raw), int(cut.sum()), spans, hashlib.sha256(kept).hexdigest()
        )
    assert repeats.without_repeats(make([])).count() == 0
    assert repeats.without_repeats(make([(None, "x" * 300)])).first()["n_removed"] == 0


def test_decontamination(make, corpus):
    rng = random.Random(9)
    items = [(k, prose(rng, n), None) for k, n in enumerate([3, 7, 12, 20, 33, 60, 150])] + [(98, None), (99, "")]
    edited = items[5][1].split(" ")
    edited[20] = "other"
    docs = [(1000 + k, prose(rng, 30) + "\n" + t.upper() + " " + prose(rng, 10)) for k, t, *_ in items[:7]]
    docs += [(2000, prose(rng, 9) + " " + " ".join(edited)), (2001, items[6][1][: len(items[6][1]) // 2])]
    docs += [(r[0], r[1]) for r in corpus]
    benchmark = make(items, "item_id long, text string, doc_id int")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(make(docs), benchmark).collect()}
    assert found == {(1000 + k, k) for k in range(7)} | {(2000, 5)}
    assert decontaminate.clean(make(docs), benchmark).count() == len(docs) - 8
    assert decontaminate.leaks(make(docs), make([], "item_id long, text string")).count() == 0


def test_decontamination_of_spread_changes(make):
    """Words changed a run apart, in items of sizes that runs of 32 don't suffice for."""
    rng = random.Random(13)
    items = [(k, prose(rng, n)) for k, n in enumerate([64, 94, 95] * 6)]
    docs = []
    for k, text in items:
        changed = text.split(" ")
        for at in (0, 32) if len(changed) == 64 else (31, 63):
            changed[at] = "changed"
        docs.append((k, prose(rng, 12) + " " + " ".join(changed) + " " + prose(rng, 12)))
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(make(docs), make(items, "item_id long, text string")).collect()}
    assert found == {(k, k) for k, _ in items}


def test_no_changes_break_all_runs():
    """The fewest shingles that changes cost which leave no whole run, against those that 0.8 allows."""
    for n in range(5, 400):
        shingle_count, size = n - 4, decontaminate.run_size(n)
        # By the place of the last change.
        cost = []
        for p in range(n):
            before = [cost[q] + min(p, n - 5) - max(p - 4, q + 1, 0) + 1 if max(p - 4, q + 1) <= n - 5 else cost[q] for q in range(max(0, p - size), p)]
            cost.append(min([*before, *([min(p, n - 5) - max(0, p - 4) + 1] if p < size else [])]))
        lost = min(cost[n - size :])
        assert 10 * (shingle_count - lost) < 8 * (shingle_count + lost)


def test_language(make):
    rng = random.Random(3)
    tongues = {"aa": "aba bab abba", "bb": "ono non onno", "cc": "isi sis issi"}
    rows = [(i, " ".join(rng.choices(tongues[k].split(), k=20)), k) for i in range(240) for k in [rng.choice(list(tongues))]]
    rows += [(900, None, "aa"), (901, "", "aa"), (902, "12 34 !", "aa"), (903, "ono non", None)]
    docs = make(rows)
    found = {r["doc_id"]: r for r in language.predicted(docs, language.learned(docs)).select("document.doc_id", "lang_pred", "score", "rejected").collect()}
    assert all(found[i]["lang_pred"] == lang for i, _, lang in rows[:240])
    assert all(found[i][1:] == ("und", 0.0, True) for i in (900, 901, 902)) and found[903]["lang_pred"] == "bb"
    assert not any(found[i]["rejected"] for i in range(240))
    nothing = language.predicted(docs, language.learned(docs.limit(0)))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}


def test_html(make):
    page = ("<html><head><title>t</title></head><body><nav>menu <a>x</a></nav><div class='ad-box'>buy</div>"
            "<article><h1>A&amp;B</h1><p>one <b>two</b>\n three<br>four<p>five<script>var x='</p>';</script>"
            "<div class=comments>me too</div><aside>side</aside></article><footer>foot &copy;</footer></body>")
    same = "<p>same words that stand on every page of this host here</p>"
    own = [f"<body>{same}<p>{i} text of its own</p></body>" for i in range(4)]
    rows = [(0, "x://h/1", page), (1, "x://h/2", None), (2, None, "plain < text &am")]
    rows += [(10 + i, f"x://h/{i}", t) for i, t in enumerate(own)]
    found = {r["page_id"]: r["text"] for r in html.main_text(make(rows, "page_id long, url string, html string, text int")).collect()}
    assert found[0] == "A&B one two three four five" and found[1] == "" and found[2] == decoder.unescape("plain < text &am")
    assert [found[10 + i] for i in range(4)] == [f"{i} text of its own" for i in range(4)]


def test_html_repeats_of_a_host(make):
    """Against brute force over all repeats; two pages are enough, copies are one page."""
    rng = random.Random(21)
    long, short = prose(rng, 14), "read more"
    own = [prose(rng, 30) for _ in range(6)]
    # Hosts h and i have boilerplate on two pages; pages 3 and 4 are copies in different markup.
    rows = [(0, "x://h/0", f"<p>{own[0]}<p>{long}<p>{short}"), (1, "x://h/1", f"<p>{short}<p>{own[1]} {long} end"),
            (2, "x://h/2", f"<p>{own[2]} {short} x"), (3, "x://h/3", f"<p>{own[3]}<p>z"), (4, "x://h/4", f"<div>{own[3]}<br>z"),
            (5, "x://i/0", f"<p>{short}<p>{own[4]}"), (6, "x://i/1", f"<p>{own[4].split(' ', 20)[20]} {own[5]}"), (7, "x://j/0", own[4])]
    found = {r["page_id"]: r["text"] for r in html.main_text(make(rows, "page_id long, url string, html string")).collect()}
    cut = {i: html.blocks(t)[0] for i, _, t in rows}
    tokens = {i: " ".join(parts).split() for i, parts in cut.items()}
    for i, url, _ in rows:
        others = [j for j, u, _ in rows if u[4] == url[4] and tokens[j] != tokens[i]]
        gone = set()
        for a in range(len(tokens[i])):
            for b in range(a + html.LONG, len(tokens[i]) + 1):
                if any(f" {' '.join(tokens[i][a:b])} " in f" {' '.join(tokens[j])} " for j in others):
                    gone |= set(range(a, b))
        at = 0
        for part in cut[i]:
            n = len(part.split())
            if n < html.LONG and any(part in cut[j] for j in others):
                gone |= set(range(at, at + n))
            at += n
        assert found[i] == " ".join(t for k, t in enumerate(tokens[i]) if k not in gone)
    assert found[0] == own[0] and found[1] == own[1] + " end" and found[3] == found[4] == own[3] + " z"
    assert found[2].endswith("read more x") and found[5].startswith("read more") and found[7] == own[4]


def test_html_all_pages_are_in_the_order(make, monkeypatch):
    """Pages that name their article too: it vouches for its text, what stands outside is evidence."""
    rng = random.Random(8)
    bar, shared, twice = prose(rng, 9), prose(rng, 12), prose(rng, 10)
    own = [prose(rng, 20) for _ in range(6)]
    rows = [(0, "x://h/0", f"<p>{bar}</p><article><p>{own[0]}<p>{shared}</article><nav>menu</nav>"),
            (1, "x://h/1", f"<p>{bar}<p>{own[1]}"), (2, "x://h/2", f"<p>{own[2]}<p>{shared}<p>{twice}"),
            (3, "x://h/3", f"<p>{shared}<p>{own[3]}<p>{twice}"), (4, "x://i/0", f"<p>{own[4]}<p>{shared}"),
            (5, "x://i/1", f"<article>{own[5]}</article>"), (6, "x://i/2", f"<article>{own[5]}</article>"), (7, None, f"<article>{bar}</article>")]
    order, seen = html.suffix_order, []
    monkeypatch.setattr(html, "suffix_order", lambda pages: seen.append(pages) or order(pages))
    told = html.main_text(make(rows, "page_id long, url string, html string")).collect()
    found = {r["page_id"]: r["text"] for r in told}
    assert {r["page_id"]: r["n_repeated"] for r in told if r["n_repeated"]} == {0: 12, 2: 12, 3: 12}
    assert found == {0: f"{own[0]} {shared}", 1: own[1], 2: f"{own[2]} {shared}", 3: f"{shared} {own[3]}",
                     4: f"{own[4]} {shared}", 5: own[5], 6: own[5], 7: bar}
    texts = sorted((r["host"], " ".join(r["blocks"]), r["page"] < 0) for r in seen[0].collect())
    assert texts == sorted([("h", bar, False), ("h", f"{own[0]} {shared}", True), ("h", f"{bar} {own[1]}", False),
                            ("h", f"{own[2]} {shared} {twice}", False), ("h", f"{shared} {own[3]} {twice}", False),
                            ("i", f"{own[4]} {shared}", False), ("i", own[5], True), ("i", own[5], True)])


def test_html_suffixes_of_a_host_are_in_order(make):
    rng = random.Random(5)
    line = prose(rng, 12)
    pages = [("h", 1, [prose(rng, 5), line]), ("h", 2, ["Read more", line + " end"]), ("h", 3, ["read MORE"]), ("i", 4, [line])]
    order = html.suffix_order(make(pages, "host string, page long, blocks array<string>"))
    assert "rangepartitioning(host" in order._jdf.queryExecution().executedPlan().toString()
    rows = [tuple(r) for r in order.collect()]
    assert [r[:2] for r in rows] == sorted(r[:2] for r in rows)
    wanted = [(host, suffix, page, starts) for host, page, parts in pages for suffix, starts in html.suffixes(parts).items()]
    assert sorted(rows) == sorted(wanted)
    found = sorted(html.shared(rows))
    lines = [(1, [5 + k], html.LONG) for k in range(5)] + [(2, [2 + k], html.LONG) for k in range(5)]
    assert found == sorted(lines + [(2, [0], 2), (3, [0], 2)])


def test_html_of_many_open_elements():
    items = "".join(f"<li>i{k}" for k in range(500))
    bold = "".join(f"<b>w{k} " for k in range(500))
    assert html.blocks(f"<article>a<aside><ul>{items}</ul></aside><p>rest</p></article>out") == (["a", "rest"], True)
    assert html.blocks(f"<nav><ul>{items}</ul></nav><p>rest") == (["rest"], False)
    assert html.blocks(f"<article><p>{bold}</article>out")[0] == [" ".join(f"w{k}" for k in range(500))]
    assert html.blocks(f"<div class=menu>{'<div>x<b>' * 300}</div>" + "</div>" * 300 + "<p>rest")[0] == ["rest"]
    # The next item ends one that is dropped, an inner list's doesn't.
    assert html.blocks("<ul><li class=ad>x<ul><li>y<li>z</ul>w<li>kept</ul>")[0] == ["kept"]
    assert html.blocks("<table><tr><td class=ad>x<td>kept<tr class=ad><td>y<table><tr><td>z</table><tr><td>too</table>")[0] == ["kept", "too"]
    assert html.blocks("<dl><dt hidden>x<dd>kept<dd hidden>y<dt>too</dl>")[0] == ["kept", "too"]
    assert html.blocks("<datalist><option hidden>x<option>kept</datalist>")[0] == ["kept"]


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    data = centres[rng.integers(0, 12, 1500)] + 0.3 * rng.normal(size=(1500, 16))
    data[77] = data[20]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    rows += [(3000, None), (3020, [0.0] * 16), (3040, [float("nan")] * 16), (3060, [1.0, None] * 8), (3080, [1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = F.col("vec_id") % 20 == 0
    found = neighbours.search(table, asked)
    exact = {}
    for q in range(0, 1500, 20):
        score = (data * data[q]).sum(axis=1)
        score[q] = -np.inf
        exact[q] = set(np.lexsort((np.arange(1500), -score))[:20].tolist())
    got = {}
    for r in found.collect():
        got.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
        assert r["score"] == pytest.approx(float(data[r["vec_id"]] @ data[r["query_id"]]))
    assert set(got) == set(exact) and all(len(v) == 20 for v in got.values())
    assert sum(len(exact[q] & set(got[q])) for q in exact) / (20 * len(exact)) >= 0.9
    assert neighbours.search(table.limit(0), asked).count() == 0
    few = neighbours.search(table.where("vec_id IN (0, 20, 21)"), asked)
    assert few.count() == 4


def test_token_counts(make, corpus, tmp_path, spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    odd = ["a  b", " a", "a ", "a\n\nb", "a \n b", "it's\nTHE 'll", "x <|endoftext|> y<|endoftext|>", "\u00a0a \u2003b", "tab\there  now"]
    rows = corpus + [(500 + i, t) for i, t in enumerate(odd)] + [(None, "only here"), (None, "a  b")]
    cache = tokens.TokenCache(spark, f"file://{tmp_path}/cache")
    model = Tokenizer.from_file(path)
    want = Counter((r[0], len(model.encode(r[1] or "", add_special_tokens=False))) for r in rows)
    assert Counter((r["doc_id"], r["n_tokens"]) for r in tokens.token_counts(make(rows), path, cache).collect()) == want
    stored = spark.read.parquet(cache.folder).count()
    again = tokens.token_counts(make(rows), path, cache).collect()
    assert Counter((r["doc_id"], r["n_tokens"]) for r in again) == want
    assert spark.read.parquet(cache.folder).count() == stored
