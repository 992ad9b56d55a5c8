"""Licences against plain Dice over all units and windows; main text on hand-marked pages."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from turnloom.llm import html_blocks, license_scan
from turnloom.llm.license_scan import LEVELS, TEMPLATES, THRESHOLD, WHOLE_BIGRAMS, WINDOW_BIGRAMS


def words_at(text):
    return [(m[0].lower(), m.start(), m.end()) for m in re.finditer(r"[0-9A-Za-z\x80-\U0010ffff]+", text)]


def plain_scan(text, templates):
    """All units and windows, one by one."""
    words = words_at(text)
    grams = [(a[0], b[0]) for a, b in zip(words, words[1:])]
    between = [text[a[2] : b[1]] for a, b in zip(words, words[1:])]
    breaks = {
        "sentence": lambda g: "\n" in g or re.search(r"[.!?](?=[ \t\r\n])", g),
        "line": lambda g: "\n" in g,
        "paragraph": lambda g: g.count("\n") > 1,
        "text": lambda g: False,
    }
    found = []

    def judge(first, last, rank, name, counts, m, size):
        both = sum((Counter(grams[first:last]) & counts).values())
        if 2 * both >= THRESHOLD * (size + m) and (m >= WHOLE_BIGRAMS or both == m):
            return (-(2 * both / (size + m)) * both, words[first][1], rank, name, words[last][2], 2 * both / (size + m)), both
        return None, both

    for rank, level in enumerate(LEVELS[:-1]):
        edges = [0] + [i + 1 for i, gap in enumerate(between) if breaks[level](gap)] + [len(words)]
        for first, end in zip(edges, edges[1:]):
            for name, counts, m in templates if end - first > 1 else ():
                value, _ = judge(first, end - 1, rank, name, counts, m, end - 1 - first)
                found += [value] if value else []
    for name, counts, m in templates:
        if m < WINDOW_BIGRAMS:
            continue
        rows = []
        for first in [i for i, g in enumerate(grams) if g in counts]:
            last = max(i for i in range(first, min(first + m, len(grams))) if grams[i] in counts)
            rows.append(judge(first, last + 1, len(LEVELS) - 1, name, counts, m, m))
        for i, (value, both) in enumerate(rows):
            good = lambda k: 0 <= k < len(rows) and rows[k][0]
            if value and not (good(i - 1) and rows[i - 1][1] >= both) and not (good(i + 1) and rows[i + 1][1] > both):
                found.append(value)
    taken, best = [], {}
    for _, begin, rank, name, end, score in sorted(found):
        if all(end <= a or begin >= b for a, b in taken):
            taken.append((begin, end))
            best.setdefault(name, (name, round(score, 9), LEVELS[rank], begin, end))
    return set(best.values())


def plain_templates():
    rows = []
    for name, texts in TEMPLATES.items():
        for text in texts:
            w = [x[0] for x in words_at(text)]
            rows.append((name, Counter(zip(w, w[1:])), len(w) - 1))
    return rows


def test_licences_equal_plain_dice(spark):
    draw = random.Random(4)
    noise = "the of software in this code is free to any copy and public license x = y ( ) ; value".split()
    parts = [t for texts in TEMPLATES.values() for t in texts]
    texts = []
    for _ in range(60):
        pieces = []
        for _ in range(draw.randrange(1, 5)):
            piece = draw.choice(parts).split()
            for _ in range(draw.choice([0, 0, 1, 3, 12])):
                piece[draw.randrange(len(piece))] = draw.choice(noise)
            pieces.append(" ".join(piece))
            pieces.append(" ".join(draw.choices(noise, k=draw.randrange(0, 25))))
        joint = draw.choice([" ", "\n", "\n\n", ". "])
        texts.append(joint.join(pieces))
    mit = TEMPLATES["MIT"][3]
    texts += [mit + " " + mit, mit[: len(mit) // 2], "SPDX-License-Identifier:", "// SPDX-License-Identifier: ISC\nx", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {i: set() for i in range(len(texts))}
    for r in license_scan.scan_licenses(docs).collect():
        got[r["doc_id"]].add((r["license"], round(r["score"], 9), r["level"], r["start"], r["end"]))
    known = plain_templates()
    for i, text in enumerate(texts):
        assert got[i] == plain_scan(text or "", known), text


def test_licence_with_title_and_code_around_it(spark):
    mit = TEMPLATES["MIT"][3]
    cut = mit.index(" The above"), mit.index(" THE SOFTWARE IS")
    full = f"MIT License\n\nCopyright (c) 2020 Some One\n\n{mit[: cut[0]]}\n\n{mit[cut[0] : cut[1]]}\n\n{mit[cut[1] :]}\n"
    bsd = "Copyright 1999, X.\n\n" + TEMPLATES["BSD-3-Clause"][1].replace(". ", ".\n\n")
    affero = TEMPLATES["AGPL-3.0"][1]
    texts = [full, full + "\n\nimport os\n\ndef main():\n    return 1\n" * 40, "x = 1\n" * 50 + bsd + "\ny = 2" * 50]
    texts += ["\n".join("# " + affero[i : i + 60] for i in range(0, len(affero), 60)), "/* SPDX-License-Identifier: Apache-2.0 */\nint x;"]
    docs = spark.createDataFrame(list(enumerate(texts * 2)), "doc_id bigint, text string")
    clash = docs.withColumns({c: F.lit("x") for c in ("license", "score", "level", "start", "_text")})
    found = {(r["doc_id"] % 5, r["license"]) for r in license_scan.scan_licenses(clash).collect()}
    assert {(0, "MIT"), (1, "MIT"), (2, "BSD-3-Clause"), (4, "Apache-2.0")} <= found
    assert not {(2, "BSD-2-Clause"), (0, "ISC")} & found
    assert license_scan.scan_licenses(clash).count() == 2 * len(found)


PAGES = {
    "hyphenated names": (
        "<nav><a href=x>Home page</a></nav><main><div class='login-story'><p>{0}</p><p>{1}</p></div>"
        "<section class='share-prices'><p>{2}</p></section></main><div class='share-buttons'>Share this</div>",
        "{0}|{1}|{2}",
    ),
    "headings": (
        "<div class='site-header'>The daily site</div><article><div id='body-text'><p>{0}</p><h2>A part</h2><p>{1}</p>"
        "</div></article><footer>All rights reserved</footer>",
        "{0}|A part|{1}",
    ),
    "asides inside": (
        "<article><p>{0}</p><div class='ad-slot'>Buy now</div><p>{1}</p><div class='related-posts'><h3>More</h3>"
        "<ul><li><a href=y>Other</a></li></ul></div></article><div class='comment-list'><p>{2}</p></div>",
        "{0}|{1}",
    ),
}


@pytest.fixture(scope="module")
def labelled(spark, sf_dir):
    """Texts of the hand-marked pages, with the network trained on the table."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    long = [b.text for r in pages.limit(5).collect() for b in html_blocks.blocks_of(r["html"]) if len(b.text) > 200][:3]
    own = [(-1 - i, "u", "<html><body>" + p.format(*long) + "</body></html>") for i, (p, _) in enumerate(PAGES.values())]
    both = pages.union(spark.createDataFrame(own * 2, pages.schema)).withColumn("text", F.lit("x")).withColumn("n_chars", F.lit("x"))
    rows = html_blocks.extract_main_text(both).filter("page_id < 0").collect()
    assert len(rows) == 2 * len(PAGES) == 2 * len({(r["page_id"], r["text"]) for r in rows})
    return {r["page_id"]: r["text"] for r in rows}, long


@pytest.mark.parametrize("at", range(len(PAGES)), ids=list(PAGES))
def test_main_text_of_marked_pages(labelled, at):
    texts, long = labelled
    expected = list(PAGES.values())[at][1].format(*long).split("|")
    assert texts[-1 - at].split("\n\n") == expected


def test_training_pages_are_different_and_bounded(spark):
    rows = [(f"<p>{i % 300}</p>",) for i in range(900)] + [(None,), ("",), ("x" * 60_000,)]
    pages = spark.createDataFrame(rows, "html string").repartition(7)
    chosen = html_blocks.training_pages(pages, "html")
    assert len(chosen) == len(set(chosen)) == html_blocks.TRAIN_PAGES
    assert chosen == html_blocks.training_pages(pages.repartition(3), "html")
