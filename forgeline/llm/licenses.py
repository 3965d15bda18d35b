"""License scan: ordered signature rules behind a keyword prefilter, all in DataFrame functions.

Every rule is a regular expression with a keyword that its matches must contain, a tier (the
lower, the stronger) and a label.  A text is tried only by the rules whose keyword it contains.  A
detection that lies inside another of the same or a stronger tier is suppressed.
"""

from __future__ import annotations

from functools import lru_cache, reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forgeline.llm.common import ascii_lower, materialize, release, table

# fixed values: the phrases whose places are counted, and their labels
BASE_PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
# confidence of a detection by tier: identifier, versioned notice, name, mention
CONFIDENCE = (1.0, 0.95, 0.8, 0.4)
BASE_CONFIDENCE = 0.6
# every keyword contains one of these; a text with none of them meets no rule
ANCHORS = ("licen", "copyright", "copyleft", "public domain", "rights reserved", "creativecommons", "gpl", "cc by", "cc-by", "cc0", "unlicense",
           "without warranty", "redistribution and use", "permission is hereby granted", "permission to use")
# a text with an anchor, however its words are parted, holds all words of one of these
ANCHOR_WORDS = (("licen",), ("copyright",), ("copyleft",), ("domain",), ("reserved",), ("creativecommons",), ("gpl",), ("cc", "by"), ("cc0",),
                ("warranty",), ("redistribution",), ("permission",))
# what counts as one space: white space, and around a line end the marks of comments too
GAP = r"""(?:\s+[*#|]+)?\s*[\r\n][\s*#/;:%>!|"'.\\<-]*(?:(?:dnl|@?rem)\b\s*)?|\s+"""


class Rule(NamedTuple):
    label: str
    tier: int
    keyword: str
    pattern: str


# families with versions: label, name as a pattern, short name as a pattern, versions, host of their texts
VERSIONED = (
    ("gpl", r"(?:gnu )?general public licen[sc]e", r"(?:gnu )?gpl", ("1.0", "2.0", "3.0"), "gnu.org/licenses/gpl"),
    ("lgpl", r"(?:gnu )?(?:lesser|library) general public licen[sc]e", r"(?:gnu )?lgpl", ("2.0", "2.1", "3.0"), "gnu.org/licenses/lgpl"),
    ("agpl", r"(?:gnu )?affero general public licen[sc]e", r"(?:gnu )?agpl", ("1.0", "3.0"), "gnu.org/licenses/agpl"),
    ("gfdl", r"(?:gnu )?free documentation licen[sc]e", r"gfdl licen[sc]e", ("1.1", "1.2", "1.3"), "gnu.org/licenses/fdl"),
    ("apache", r"apache (?:software )?licen[sc]e", r"apache licensed", ("1.0", "1.1", "2.0"), "apache.org/licenses/license"),
    ("mpl", r"mozilla public licen[sc]e", r"mpl licen[sc]e", ("1.0", "1.1", "2.0"), "mozilla.org/mpl"),
    ("epl", r"eclipse public licen[sc]e", r"epl licen[sc]e", ("1.0", "2.0"), "eclipse.org/legal/epl"),
    ("cddl", r"common development and distribution licen[sc]e", r"cddl licen[sc]e", ("1.0", "1.1"), "opensource.org/licenses/cddl"),
    ("cpl", r"common public licen[sc]e", r"cpl licen[sc]e", ("1.0",), "opensource.org/licenses/cpl"),
    ("eupl", r"european union public licen[sc]e", r"eupl licen[sc]e", ("1.0", "1.1", "1.2"), "opensource.org/licenses/eupl"),
    ("artistic", r"artistic licen[sc]e", r"perl artistic licen[sc]e", ("1.0", "2.0"), "opensource.org/licenses/artistic"),
    ("boost", r"boost software licen[sc]e", r"bsl licen[sc]e", ("1.0",), "boost.org/license"),
    ("osl", r"open software licen[sc]e", r"osl licen[sc]e", ("1.0", "2.0", "2.1", "3.0"), "opensource.org/licenses/osl"),
    ("afl", r"academic free licen[sc]e", r"afl licen[sc]e", ("1.1", "1.2", "2.0", "2.1", "3.0"), "opensource.org/licenses/afl"),
    ("ofl", r"(?:sil )?open font licen[sc]e", r"ofl licen[sc]e", ("1.0", "1.1"), "scripts.sil.org/license/ofl"),
    ("odc-by", r"open data commons attribution licen[sc]e", r"odc-by licen[sc]e", ("1.0",), "opendatacommons.org/licenses/by"),
    ("odbl", r"open database licen[sc]e", r"odbl licen[sc]e", ("1.0",), "opendatacommons.org/licenses/odbl"),
    ("zpl", r"zope public licen[sc]e", r"zpl licen[sc]e", ("1.1", "2.0", "2.1"), "opensource.org/licenses/zpl"),
    ("php", r"php licen[sc]e", r"php licensed", ("3.0", "3.01"), "php.net/license"),
    ("python", r"python (?:software foundation )?licen[sc]e", r"psf licen[sc]e", ("2.0",), "opensource.org/licenses/python"),
    ("lppl", r"latex project public licen[sc]e", r"lppl licen[sc]e", ("1.0", "1.1", "1.2", "1.3"), "latex-project.org/lppl/license"),
    ("ms-pl", r"microsoft public licen[sc]e", r"ms-pl licen[sc]e", ("1.0",), "opensource.org/licenses/ms-pl"),
    ("cecill", r"cecill(?:-[bc])? licen[sc]e", r"cecill licensed", ("1.0", "1.1", "2.0", "2.1"), "cecill.info/licences"),
    ("npl", r"netscape public licen[sc]e", r"npl licen[sc]e", ("1.0", "1.1"), "mozilla.org/mpl/npl/license"),
    ("qpl", r"q public licen[sc]e", r"qpl licen[sc]e", ("1.0",), "opensource.org/licenses/qpl"),
    ("ecl", r"educational community licen[sc]e", r"ecl licen[sc]e", ("1.0", "2.0"), "opensource.org/licenses/ecl"),
)
CC_PARTS = ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
CC_WORDS = {"by": "attribution", "sa": "share-?alike", "nd": "no-?deriv(?:ative)?s?", "nc": "non-?commercial"}

# licences without versions: label, tier, keyword, pattern
SINGLE = tuple(Rule(*r) for r in (
    ("mit", 2, "licen", r"\b(?:the )?(?:mit|expat)[ /-](?:x11[ -])?licen[sc]ed?\b"),
    ("mit", 1, "licen", r"\b(?:released|licen[sc]ed|distributed|available) under (?:the )?(?:terms of the )?mit licen[sc]e\b"),
    ("mit", 1, "permission is hereby granted", r"\bpermission is hereby granted, free of charge, to any person obtaining a copy\b"),
    ("mit", 0, "licen", r"\bspdx-license-identifier:\s*mit\b"),
    ("bsd-2-clause", 1, "licen", r"\b(?:bsd[ -]2[ -]clause|2[ -]clause bsd|simplified bsd|freebsd)[ -]licen[sc]e\b"),
    ("bsd-3-clause", 1, "licen", r"\b(?:bsd[ -]3[ -]clause|3[ -]clause bsd|new bsd|modified bsd|revised bsd)[ -]licen[sc]e\b"),
    ("bsd-4-clause", 1, "licen", r"\b(?:bsd[ -]4[ -]clause|4[ -]clause bsd|original bsd)[ -]licen[sc]e\b"),
    ("bsd", 2, "licen", r"\bbsd[ -](?:style )?licen[sc]ed?\b"),
    ("bsd", 1, "redistribution and use", r"\bredistribution and use in source and binary forms, with or without modification\b"),
    ("bsd-2-clause", 0, "licen", r"\bspdx-license-identifier:\s*bsd-2-clause\b"),
    ("bsd-3-clause", 0, "licen", r"\bspdx-license-identifier:\s*bsd-3-clause\b"),
    ("isc", 2, "licen", r"\bisc licen[sc]ed?\b"),
    ("isc", 1, "permission to use", r"\bpermission to use, copy, modify, and(?:/or)? distribute this software for any purpose\b"),
    ("isc", 0, "licen", r"\bspdx-license-identifier:\s*isc\b"),
    ("zlib", 2, "licen", r"\b(?:zlib|libpng|zlib/libpng) licen[sc]e\b"),
    ("zlib", 0, "licen", r"\bspdx-license-identifier:\s*zlib\b"),
    ("unlicense", 2, "unlicense", r"\b(?:the )?unlicense\b"),
    ("wtfpl", 2, "licen", r"\bdo what the f\w*ck you want to public licen[sc]e\b"),
    ("cc0", 1, "cc0", r"\bcc0(?:[ -]1\.0)?\b"),
    ("cc0", 1, "creativecommons", r"\bcreativecommons\.org/publicdomain/zero/1\.0\b"),
    ("public-domain", 2, "public domain", r"\b(?:dedicated to|placed in|released into|in) the public domain\b"),
    ("public-domain", 3, "public domain", r"\bpublic domain\b"),
    ("postgresql", 2, "licen", r"\bpostgresql licen[sc]e\b"),
    ("ncsa", 2, "licen", r"\b(?:university of illinois/)?ncsa open source licen[sc]e\b"),
    ("openssl", 2, "licen", r"\bopenssl licen[sc]e\b"),
    ("vim", 2, "licen", r"\bvim licen[sc]e\b"),
    ("ruby", 2, "licen", r"\bruby licen[sc]e\b"),
    ("beerware", 2, "licen", r"\bbeer-?ware licen[sc]e\b"),
    ("curl", 2, "licen", r"\bcurl licen[sc]e\b"),
    ("x11", 2, "licen", r"\bx11 licen[sc]e\b"),
    ("open-government", 2, "licen", r"\bopen government licen[sc]e(?: v\d(?:\.\d)?)?\b"),
    ("proprietary", 1, "licen", r"\b(?:commercial|proprietary) licen[sc]e agreement\b"),
    ("proprietary", 2, "licen", r"\bend[ -]user licen[sc]e agreement\b"),
    ("proprietary", 2, "rights reserved", r"\ball rights reserved\b"),
    ("copyright", 3, "copyright", r"\bcopyright(?: \(c\)| ©)?(?: \d{4}(?:-\d{4})?)?\b"),
    ("copyleft", 3, "copyleft", r"\bcopyleft\b"),
    ("no-warranty", 3, "without warranty", r"\bwithout warranty of any kind\b"),
    ("mention", 3, "licen", r"\b(?:re-?)?licen[sc]ed (?:under|to|by)\b"),
    ("mention", 3, "licen", r"\bunder (?:the )?(?:terms of (?:the|this) )?licen[sc]e\b"),
))


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules, strongest tier first."""
    out = list(SINGLE)
    for label, name, short, versions, host in VERSIONED:
        word = "gpl" if "gpl" in label else "licen"
        out.append(Rule(label, 2, "licen", rf"\b{name}\b"))
        out.append(Rule(label, 2, word, rf"\b{short}\b"))
        for version in versions:
            # "3.0" is also written "3"; "2.1" is not "2"
            number = version[:-2] + r"(?:\.0)?" if version.endswith(".0") else version.replace(".", r"\.")
            tail = rf",? \(?(?:version|ver\.?|v\.?)? ?{number}(?![\d.]*\d)(?: or (?:any )?later)?"
            out.append(Rule(f"{label}-{version}", 1, "licen", rf"\b{name}{tail}"))
            out.append(Rule(f"{label}-{version}", 1, word, rf"\b{short}(?:{tail}|[- ]?v?{number}(?![\d.]*\d))"))
            exact = version.replace(".", r"\.")
            out.append(Rule(f"{label}-{version}", 0, "licen", rf"\bspdx-license-identifier:\s*{label}-{exact}(?:-only|-or-later|\+)?(?![\w.])"))
            address = host.replace(".", r"\.")
            out.append(Rule(f"{label}-{version}", 1, "licen", rf"\b{address}[-/_v]*{exact}") if "licen" in host
                       else Rule(f"{label}-{version}", 2, "licen", rf"\blicen[sc]e: *https?://(?:www\.)?{address}[-/_v]*{exact}"))
    for parts in CC_PARTS:
        words = r"[- ,]+".join(CC_WORDS[p] for p in parts.split("-"))
        dashes = parts.replace("-", "[- ]")
        out.append(Rule(f"cc-{parts}", 2, "licen", rf"\bcreative commons {words} licen[sc]e\b"))
        for key in ("cc by", "cc-by"):
            out.append(Rule(f"cc-{parts}", 2, key, rf"\b{key[:3]}{dashes}(?![- ](?:nc|nd|sa)\b)"))
        for version in CC_VERSIONS:
            exact = version.replace(".", r"\.")
            for key in ("cc by", "cc-by"):
                out.append(Rule(f"cc-{parts}-{version}", 1, key, rf"\b{key[:3]}{dashes}[- ]{exact}(?![\d.]*\d)"))
            out.append(Rule(f"cc-{parts}-{version}", 1, "licen", rf"\bcreative commons {words}[- ,]+(?:version )?{exact}(?: \w+)? licen[sc]e\b"))
            out.append(Rule(f"cc-{parts}-{version}", 1, "creativecommons", rf"\bcreativecommons\.org/licen[sc]es/{parts}/{exact}"))
            out.append(Rule(f"cc-{parts}-{version}", 0, "licen", rf"\bspdx-license-identifier:\s*cc-{parts}-{exact}\b"))
    return tuple(sorted(out, key=lambda r: r.tier))


def _words_in(spaced):
    """Number of words of ' a  b ' (each word between spaces of its own)."""
    return F.when(F.trim(spaced) == "", F.lit(0)).otherwise(
        F.char_length(F.trim(spaced)) - F.char_length(F.replace(F.trim(spaced), F.lit("  "), F.lit(" "))) + 1).cast("long")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are maximal runs of a-z (A-Z lower-cased), digits and non-ASCII characters.  n_base counts
    all places of the base phrases, first_word and last_word are the smallest and largest of their
    starts (null if none).  ``labels`` joins the base labels and those of the detections that no
    other suppresses; score is the confidence of the surest.  Rules meet the text with each run of
    white space, and of comment marks around a line end, as one space.  A null text counts as empty; a text
    without words or detections has empty labels and score 0; null and repeated ids stay as they
    are, an empty table gives no rows, and other columns are not read.
    """
    low = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    trimmed = F.trim(F.regexp_replace(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "  "))
    some = reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [F.contains(low, F.lit(w)) for w in ws]) for ws in ANCHOR_WORDS])
    gate = reduce(lambda a, b: a | b, [F.contains(F.col("low"), F.lit(a)) for a in ANCHORS])
    rows = (docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.when(some, F.regexp_replace(low, GAP, " ")).alias("low"),
                        F.when(trimmed == "", F.lit("")).otherwise(F.concat(F.lit(" "), trimmed, F.lit(" "))).alias("spaced"))
            .select("row", "id", "low", "spaced", _words_in(F.col("spaced")).alias("n_words"),
                    F.coalesce(gate, F.lit(False)).alias("gate")))
    counts, firsts, lasts, names = [], [], [], []
    for phrase, label in BASE_PHRASES:
        needle = F.lit(" " + phrase.replace(" ", "  ") + " ")
        has = F.col("gate") & F.contains(F.col("spaced"), needle)
        size = len(phrase.split())
        counts.append(F.when(has, (F.char_length("spaced") - F.char_length(F.replace(F.col("spaced"), needle, F.lit(""))))
                             / F.char_length(needle)).otherwise(0).cast("long"))
        firsts.append(F.when(has, _words_in(F.substring_index("spaced", " " + phrase.replace(" ", "  ") + " ", 1))))
        lasts.append(F.when(has, F.col("n_words") - size - _words_in(F.substring_index("spaced", " " + phrase.replace(" ", "  ") + " ", -1))))
        names.append(F.when(has, F.lit(label)))
    rows = materialize(rows.select(
        "row", "id", "n_words", reduce(lambda a, b: a + b, counts).alias("n_base"), F.least(*firsts).alias("first_word"),
        F.greatest(*lasts).alias("last_word"), F.array_sort(F.array_compact(F.array(*names))).alias("base"),
        F.when(F.col("gate"), F.col("low")).alias("low")), "license-rows")
    found = materialize(_detections(rows.where("low IS NOT NULL").select("row", "low")), "license-found")
    labels = F.array_sort(F.array_union("base", F.coalesce("found", F.array().cast("array<string>"))))
    return rows.drop("low").join(found, "row", "left").select(
        "id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.greatest(F.coalesce("sure", F.lit(0.0)), F.when(F.size("base") > 0, F.lit(BASE_CONFIDENCE)).otherwise(0.0)).alias("score"))


def _detections(texts: DataFrame) -> DataFrame:
    """(row, found labels, confidence of the surest) of the detections that are not suppressed."""
    table_of_rules = F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(r.tier).alias("tier"), F.lit(r.label).alias("label"),
                                        F.lit(r.keyword).alias("keyword"), F.lit(r.pattern).alias("pattern")) for i, r in enumerate(rules())])
    tried = (texts.select("row", "low", F.explode(F.filter(table_of_rules, lambda r: F.contains(F.col("low"), r["keyword"]))).alias("r"))
             .where(F.expr("low RLIKE r.pattern")))
    # the text between matches and the matches themselves, in turn, give each match its place
    pieces = tried.select("row", F.col("r.rule"), F.col("r.tier"), F.col("r.label"), F.posexplode(F.arrays_zip(
        F.expr("transform(split(low, r.pattern, -1), x -> char_length(x))").alias("gap"),
        F.expr("transform(regexp_extract_all(low, r.pattern, 0), x -> char_length(x))").alias("size"))).alias("k", "p"))
    before = Window.partitionBy("row", "rule").orderBy("k")
    spans = (pieces.select("row", "rule", "tier", "label", F.col("p.size").alias("size"),
                           (F.sum(F.col("p.gap") + F.coalesce("p.size", F.lit(0))).over(before)).alias("end"))
             .where("size IS NOT NULL").select("row", "rule", "tier", "label", (F.col("end") - F.col("size")).alias("start"), "end"))
    # widest first from each start: a span lies inside an earlier one if one of those ends as late or later
    order = Window.partitionBy("row").orderBy("start", F.desc("end"), "tier", "rule").rowsBetween(Window.unboundedPreceding, -1)
    reach = [F.max(F.when(F.col("tier") <= t, F.col("end"))).over(order) for t in range(len(CONFIDENCE))]
    marked = spans.select("*", *[r.alias(f"reach{t}") for t, r in enumerate(reach)])
    covering = reduce(lambda c, t: c.when(F.col("tier") == t, F.col(f"reach{t}")), range(1, len(CONFIDENCE)), F.when(F.col("tier") == 0, F.col("reach0")))
    free = marked.where(F.coalesce(covering < F.col("end"), F.lit(True)))
    sure = reduce(lambda c, t: c.when(F.col("tier") == t, F.lit(CONFIDENCE[t])), range(1, len(CONFIDENCE)), F.when(F.col("tier") == 0, F.lit(CONFIDENCE[0])))
    return free.groupBy("row").agg(F.array_sort(F.collect_set("label")).alias("found"), F.max(sure).alias("sure"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License scan of every row of ``documents``."""
    return scan_licenses(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
