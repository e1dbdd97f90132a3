"""Site style trees: entropies and verdicts a second way, and verdicts without any list of names."""

import math
import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from plumbline.llm import html_text
from plumbline.llm.base import settle

BIG = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def spark(spark):
    return settle(spark)


def site(rng, host, n, notice="Offers of the week"):
    """Pages of one template without any telling name: a list of links, a notice, the story, a credit line."""
    words = [f"w{i}" for i in range(300)]
    prose = lambda k: " ".join(rng.choices(words, k=k))
    out = []
    for i in range(n):
        story = "".join(f"<p>{prose(rng.randint(5, 30))}</p>" for _ in range(rng.randint(2, 6)))
        fixed = '<div class="z3">Always the same words stand here.</div>' if rng.random() < 0.9 else ""
        out.append((len(out), f"http://{host}/{i}", f'<html><body><div class="x1"><ul><li>Home</li><li>{rng.choice(words[:20])}</li></ul></div><div class="x2">{notice} {rng.randint(1, 4)}</div>'
                    f'<div class="x4"><h2>{prose(6)}</h2>{fixed}{story}</div><div class="x5">Set by {rng.choice("ABC")}</div></body></html>'))
    return out


def entropy(values):
    counts, n = Counter(values), len(values)
    return 1.0 if n == 1 else -sum(c / n * math.log(c / n) for c in counts.values()) / math.log(n)


def test_entropies_and_verdicts_are_brute_force(spark):
    rng = random.Random(3)
    pages = site(rng, "one.example", 40) + site(rng, "two.example", 12, "Notes") + site(rng, "few.example", 3) + [(9, None, None), (10, "nonsense", "<p>x</p>")]
    rows = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    tree = html_text.style_tree(rows)
    nodes = defaultdict(list)
    for _, url, source in pages:
        page = html_text.Page(source or "")
        for path, times, style, text in [("", 1, "", "\n".join(b[0] for b in page.blocks)), *page.nodes()]:
            nodes[html_text.host_of(url), path].append((times, style, text))
    named = {(h, html_text._hash(p) if p else 0): (h, p) for h, p in nodes}
    got = {named[r.host, r.path]: r for r in tree.collect()}
    assert set(got) == set(nodes)
    for (host, path), seen in nodes.items():
        r = got[host, path]
        assert (r.n, r.times, r.chars) == (len(seen), sum(s[0] for s in seen), sum(len(s[2]) for s in seen))
        assert r.presentation == pytest.approx(entropy([s[1] for s in seen]), abs=1e-9)
        assert r.content == pytest.approx(entropy([s[2] for s in seen]), abs=1e-9)
    low = {named[r.host, r.path] for r in html_text.low_branches(tree).collect()}
    want = set()
    for host in {h for h, _ in nodes}:
        own = {p: got[h, p] for h, p in nodes if h == host}
        weight = lambda p: own[p].chars * own[p].content
        importance = lambda p: 0.1 * own[p].presentation + 0.9 * own[p].content
        stem = [p for p, r in own.items() if r.times <= 1.2 * r.n and 2 * r.n > own[""].n and not r.running and weight(p) > 0.5 * weight("")]
        if not stem:
            continue
        main = max(stem, key=len)
        for p, r in own.items():
            if p and r.n >= 8 and p not in stem:
                leaves = p.rpartition("/")[0] in stem and not r.running
                least = max(3 * (1 - own[main].content), 0.03 if leaves else 0.5)
                if 1 - r.content >= least and importance(p) < importance(main):
                    want.add((host, p))
    assert low == want
    steps = {p.rpartition("/")[2] for h, p in low if h == "one.example"}
    assert {"div.x", "div.z"} & steps and not any("few" in h for h, _ in low)


def test_a_site_without_names_keeps_its_stories(spark):
    rng = random.Random(5)
    pages = [(i, u, h.replace("x1", "aa").replace("x2", "bb").replace("x4", "cc").replace("x5", "dd").replace("z3", "ee")) for i, u, h in site(rng, "one.example", 60)]
    rows = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    for r, (_, _, source) in zip(html_text.extract(rows, roles=False).orderBy("page_id").collect(), pages):
        story = source.partition('class="cc">')[2].partition('</div><div class="dd">')[0]
        blocks = [b[0] for b in html_text.Page(story).blocks if not b[0].startswith("Always")]
        assert r.text.split("\n") == blocks


@pytest.mark.skipif(not os.path.isdir(BIG), reason="driver tables are absent")
def test_trees_alone_remove_menus_footers_and_adverts(spark):
    pages = spark.read.parquet(f"{BIG}/pages.parquet")
    kept = {r.page_id: Counter(r.text.split("\n")) for r in html_text.extract(pages, roles=False).collect()}
    removed, junk, lost = 0, 0, 0
    for page_id, source in pages.select("page_id", "html").collect():
        left = kept[page_id].copy()
        for text, _, inside, path, _ in html_text.Page(source or "").blocks:
            if inside:
                lost += not left[text]
                left[text] -= 1
        for text, _, inside, path, _ in html_text.Page(source or "").blocks:
            if not inside:
                junk += 1
                removed += left[text] <= 0
                left[text] -= 1
    assert lost == 0 and removed >= 0.9 * junk


def test_names_remove_whole_names_only(spark):
    text = lambda source: html_text.Page(source).text(frozenset(), hash).split("\n")
    story = "<p>The market closed higher today after a long week of trading.</p>"
    assert text(f"<article><h1>Up</h1>{story}<p class='share-price'>Shares rose.</p><p id='related-work'>As told before.</p><table class='menu-prices'><tr><td>Soup 4</td></tr></table><p>End.</p></article>") == [
        "Up", "The market closed higher today after a long week of trading.", "Shares rose.", "As told before.", "Soup 4", "End."]
    assert text(f"<div class='site-footer'>x</div><div class='cookie-banner top'>y</div><div class='share-buttons'>z</div><article>{story}</article><div id='comments'>me too</div>") == [
        "The market closed higher today after a long week of trading."]
    teaser = "<article class='card'><p>Read this too.</p></article>"
    assert "The market closed higher today after a long week of trading." in text(f"<body>{teaser}<div>{story}{story}</div></body>")
