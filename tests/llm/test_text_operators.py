"""HTML extraction and license scan on literal pages and against brute force."""

import random
import re

from forgeline.llm import html_text, licenses

ARTICLE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><a href="/">Site name</a></header><nav><ul><li><a href=/a>Menu one</a></li><li>Two</li></ul></nav><!-- ad <p>x</p> -->
<div class="ad">Buy this now, a long advert sentence that is text too.</div><div id="cookie-notice">We use cookies.</div>
<article><h1>Head &lt;1&gt;</h1><p><b>First   para <i>of</i>
text<br>with a break<p>Short.</p><form><input><p>Sign up</p></form><ul><li>item&nbsp;one<li>item two</ul><aside>Side</aside>
<p>A last paragraph &copy; &#233; a < b.</p><div class="comments"><p>A reader says something quite long about all of this here.</p></div></article>
<aside class=sidebar>Sidebar words</aside><footer>&copy; foot</footer>"""


def test_article_page():
    assert html_text.main_text(ARTICLE) == "\n\n".join([
        "Head <1>", "First para of text with a break", "Short.", "item one", "item two", "A last paragraph © é a < b."])


def test_page_without_article_element():
    para = "Some words of a real paragraph that goes on for a good while, " * 3
    page = (f"<body><div class='menu'><a>Home</a><a>News</a></div><div><a>One</a></div><div><a>Two</a></div><div><a>Three</a></div><hr>"
            f"<div><p>{para}</p><p>Short one.</p><p>{para}</p></div><div><a>Next</a></div><div></div><div></div><div>tiny</div></body>")
    assert html_text.main_text(page) == "\n\n".join([para.strip(), "Short one.", para.strip()])


def test_short_last_paragraph_after_an_advert():
    long, last = "Words of a long paragraph. " * 80, "A closing paragraph of some length. " * 8
    for gap in ("", "\n"):
        page = (f"<body><div class='menu'><a>Home</a></div>{gap}<div>{gap}<div>{gap}<p>{long}</p>{gap}<div class=ad>{gap}<p>x</p>{gap}</div>{gap}<p>{last}</p>{gap}"
                f"<div class=ad><p>x</p></div>{gap}<ul><li><a>One</a><li><a>Two</a><li><a>Three</a></ul>{gap}<p>The end.</p></div></div><div><a>Next</a></div></body>")
        assert html_text.main_text(page) == "\n\n".join([long.strip(), last.strip(), "The end."])


def test_article_element_is_no_verdict():
    long = "Words of a long paragraph. " * 40
    page = f"<article><a>Teaser</a><p>Card.</p></article><div><p>{long}</p><p>The end.</p></div><div><a>Next</a></div>"
    assert html_text.main_text(page) == "\n\n".join([long.strip(), "The end."])
    links = "".join(f"<li><a>Link {i}</a></li>" for i in range(9))
    page = f"<div><p>Up</p></div><main><h1>Head</h1><p>{long}</p><p>Short.</p><ul>{links}</ul><div><p>Accept it.</p></div></main>"
    assert html_text.main_text(page) == "\n\n".join(["Head", long.strip(), "Short."])


def test_names_of_wrappers_hide_no_article():
    long, tail = "Words of a long paragraph. " * 40, "<div class='comments'><p>" + "A reader writes. " * 200 + "</p></div>"
    for name in ("class='page no-sidebar'", "class='content with-sidebar'", "class='post comments-open'", "id='social-science'", "class=search"):
        for inner in (f"<article><p>{long}</p></article>", f"<p>{long}</p>"):
            page = f"<body><div class=ad>Buy this.</div><div {name}>{inner}<div class='related'><p>Other words.</p></div></div></body>"
            assert html_text.main_text(page) == long.strip(), name
        assert html_text.main_text(f"<div {name}><article><p>{long}</p></article></div>{tail}") == long.strip()
    cards = "<article><p>A teaser of another page.</p></article>" * 3
    assert html_text.main_text(f"<div><p>{long}</p></div><div class=related>{cards}</div>") == long.strip()


def test_odd_pages(spark):
    pages = [(1, None), (2, ""), (3, "plain text only"), (4, "<p>unclosed <b>tag <"), (5, "<script>never closed"), (6, "<a href=\"x > y\">link</a><p>t</p>"),
             (7, "<article></article>"), (8, "<article>" + "<p>word word</p>" * 3000 + "</article>"), (None, "<article>Be.</article>"), (1, "</div></p>x")]
    df = spark.createDataFrame([(i, f"u{i}", h, "t", 3) for i, h in pages], "page_id long, url string, html string, text string, n_chars int")
    rows = html_text.extract_text(df).collect()
    assert len(rows) == len(pages)
    got = {(r.page_id, r.text[:30], r.n_chars) for r in rows}
    assert {(1, "", 0), (2, "", 0), (3, "plain text only", 15), (4, "unclosed tag <", 14), (5, "", 0), (7, "", 0), (None, "Be.", 3), (1, "x", 1)} <= got
    assert max(r.n_chars for r in rows) == 3000 * 9 + 2999 * 2
    assert html_text.extract_text(df.limit(0)).count() == 0


def brute_scan(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    starts, base = [], set()
    for phrase, label in licenses.BASE_PHRASES:
        p = phrase.split()
        hits = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        starts += hits
        base |= {label} if hits else set()
    found = []
    for i, r in enumerate(licenses.rules()):
        if r.keyword in low:
            found += [(m.start(), m.end(), r.tier, i, r.label) for m in re.finditer(r.pattern, low, re.A)]
    free = [f for f in found if not any(
        g is not f and g[0] <= f[0] and g[1] >= f[1] and g[2] <= f[2] and ((g[0], -g[1], g[2], g[3]) < (f[0], -f[1], f[2], f[3])) for g in found)]
    labels = sorted(base | {f[4] for f in free})
    score = max([licenses.CONFIDENCE[f[2]] for f in free] + [licenses.BASE_CONFIDENCE if base else 0.0])
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(labels), score


def test_rules_are_sound():
    every = licenses.rules()
    assert len(every) > 300 and [r.tier for r in every] == sorted(r.tier for r in every)
    assert all(any(a in r.keyword for a in licenses.ANCHORS) for r in every)
    for r in every:
        assert not re.compile(r.pattern).match("")


def test_scan_equals_brute_force(spark):
    rnd = random.Random(5)
    lines = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "licensed under cc by-nc 4.0.",
             "This work is licensed under the GNU General Public License, version 3.", "MIT license mit  License", "GPLv2 or later", "LGPL-2.1", "all rights reserved",
             "SPDX-License-Identifier: GPL-2.0-only", "gnu lesser general public license version 2.1", "Creative Commons Attribution-ShareAlike 4.0 International License",
             "https://www.apache.org/licenses/LICENSE-2.0", "the public domain", "général public licensé", "words about nothing", "mit license", "apache-license"]
    texts = [None, "", "...", "mit license", "MIT LICENSE" + " x" * 50_000, *lines]
    texts += [" ".join(rnd.choice(lines + ["and", "so", "on,"]) for _ in range(rnd.randint(1, 12))) for _ in range(60)]
    texts += ["Released under the MIT License. " * 500]
    df = spark.createDataFrame([(i, t, "c", 1, "l") for i, t in enumerate(texts)], "doc_id long, text string, low string, row int, labels string")
    rows = {r.id: tuple(r)[1:] for r in licenses.scan_licenses(df.repartition(3)).collect()}
    for i, t in enumerate(texts):
        assert rows[i] == brute_scan(t), t[:200]
    assert licenses.scan_licenses(df.limit(0)).count() == 0
    again = spark.createDataFrame([(None, "mit license"), (1, "mit license"), (1, "mit license")], "doc_id long, text string")
    assert [r.n_base for r in licenses.scan_licenses(again).collect()] == [1, 1, 1]


NOTICES = [
    ("bsd", """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:"""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted."""),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining
a copy of this software and associated documentation files"""),
    ("gpl,gpl-3.0,mention", """it under the terms of the license, licensed under the GNU General
Public License, version
3."""),
    ("mit", "This code is released under the MIT\nLicense."),
    ("proprietary", "All\nrights\nreserved."),
    ("public-domain", "This is in the public\tdomain."),
    ("cc-by-nc-4.0", "cc\nby-nc  4.0"),
]


def test_wrapped_notices(spark):
    boxed = lambda t: "/" + "*" * 60 + "\n" + "".join(f" * {x:<58} *\n" for x in t.split("\n")) + " */"
    forms = [lambda t: t, lambda t: t.replace("\n", "\r\n"), lambda t: t.replace(" ", "  "), boxed]
    forms += [lambda t, m=m: "".join(f"{m}{x}\n" for x in t.split("\n")) for m in ("# ", " * ", "// ", ";; ", "--  ", "%", ".\\\" ", "dnl ", "\t", "> ")]
    texts = [(labels, f(t)) for labels, t in NOTICES for f in forms]
    plain = [" ".join(t.split()) for _, t in NOTICES for _ in forms]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    rows = {r.id: r for r in licenses.scan_licenses(df).collect()}
    for i, (labels, t) in enumerate(texts):
        # the one-line form has the same labels and score; "dnl" stays a word between those of a base phrase
        one_line = brute_scan(plain[i])
        assert one_line[5] == labels
        got = rows[i].labels if "dnl" not in t or "gpl" not in labels else "gpl," + rows[i].labels
        assert (got, rows[i].score) == one_line[5:], t


def test_anchor_words_cover_the_anchors():
    assert all(any(all(w in a for w in words) for words in licenses.ANCHOR_WORDS) for a in licenses.ANCHORS)



def test_rules_name_versions_and_suppress():
    labels = lambda t: brute_scan(t)[5]
    assert labels("This work is licensed under the GNU General Public License, version 3.") == "gpl,gpl-3.0,mention"
    assert labels("licensed under cc by-nc 4.0.") == "cc-by-nc-4.0,mention"
    assert labels("Licensed under the Apache License, Version 2.0.") == "apache,apache-2.0,mention"
    assert labels("gnu lesser general public license version 2.1") == "gpl,lgpl-2.1"
    assert labels("Nothing at all here") == ""


def test_no_python_in_the_license_plan(spark):
    df = spark.createDataFrame([(1, "mit license")], "doc_id long, text string")
    plan = licenses._detections(df.selectExpr("doc_id AS row", "text AS low"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
