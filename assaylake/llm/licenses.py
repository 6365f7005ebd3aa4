"""License scans: ordered signature rules behind a keyword prefilter, then priority and containment.

DataFrame functions only, and no shuffle: a document's words, detections and labels are made within
its row. A rule is looked at only at words that can begin it, and only in texts that pass a gate
made from the rules, so the rules cost nothing on the rest of the table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # on text whose A-Z are lower-cased
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
REACH = 16  # words that a rule can see from its first word
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
LICENSE = "licen[cs]e"

GAP = r"(?:[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"  # what may lie between two words of a raw text


@dataclass(frozen=True)
class Rule:
    trigger: str  # the first word of every match
    pattern: str  # on the words from there on, joined by single spaces
    label: str
    tier: int  # 1 is the strongest
    confidence: float


# (label, first word, rest of the full name, short names, versions); fixed names of public licenses
FAMILIES = [
    ("apache", "apache", f"(?: software)? {LICENSE}", ("apache",), ("1.0", "1.1", "2.0")),
    ("gpl", "gnu", f"(?: gpl| general public {LICENSE})", ("gpl",), ("1.0", "2.0", "3.0")),
    ("gpl", "general", f" public {LICENSE}", (), ("1.0", "2.0", "3.0")),
    ("lgpl", "gnu", f"(?: lgpl| (?:lesser|library) general public {LICENSE})", ("lgpl",), ("2.0", "2.1", "3.0")),
    ("lgpl", "lesser", f" general public {LICENSE}", (), ("2.0", "2.1", "3.0")),
    ("agpl", "gnu", f"(?: agpl| affero general public {LICENSE})", ("agpl",), ("1.0", "3.0")),
    ("agpl", "affero", f" general public {LICENSE}", (), ("1.0", "3.0")),
    ("gfdl", "gnu", f" free documentation {LICENSE}", ("gfdl",), ("1.1", "1.2", "1.3")),
    ("mpl", "mozilla", f" public {LICENSE}", ("mpl",), ("1.0", "1.1", "2.0")),
    ("epl", "eclipse", f" public {LICENSE}", ("epl",), ("1.0", "2.0")),
    ("cddl", "common", f" development and distribution {LICENSE}", ("cddl",), ("1.0", "1.1")),
    ("cpl", "common", f" public {LICENSE}", (), ("1.0",)),
    ("eupl", "european", f" union public {LICENSE}", ("eupl",), ("1.0", "1.1", "1.2")),
    ("artistic", "artistic", f" {LICENSE}", (), ("1.0", "2.0")),
    ("bsl", "boost", f" software {LICENSE}", (), ("1.0",)),
    ("osl", "open", f" software {LICENSE}", (), ("1.0", "2.0", "2.1", "3.0")),
    ("afl", "academic", f" free {LICENSE}", (), ("1.1", "1.2", "2.0", "2.1", "3.0")),
    ("ofl", "sil", f" open font {LICENSE}", (), ("1.0", "1.1")),
    ("odbl", "open", f" database {LICENSE}", (), ("1.0",)),
    ("lppl", "latex", f" project public {LICENSE}", (), ("1.0", "1.1", "1.2", "1.3")),
    ("apsl", "apple", f" public source {LICENSE}", (), ("1.0", "1.1", "1.2", "2.0")),
    ("zpl", "zope", f" public {LICENSE}", (), ("1.1", "2.0", "2.1")),
    ("qpl", "q", f" public {LICENSE}", (), ("1.0",)),
    ("php", "php", f" {LICENSE}", (), ("3.0", "3.01")),
    ("python", "python", f"(?: software foundation)? {LICENSE}", (), ("2.0",)),
    ("ms-pl", "microsoft", f" public {LICENSE}", (), ()),
    ("ms-rl", "microsoft", f" reciprocal {LICENSE}", (), ()),
    ("unlicense", "unlicense", "", (), ()),
    ("wtfpl", "wtfpl", "", (), ("2.0",)),
    ("zlib", "zlib", f"(?: libpng)? {LICENSE}", (), ()),
    ("isc", "isc", f" {LICENSE}", (), ()),
    ("mit", "mit", f" {LICENSE}", (), ()),
    ("mit", "expat", f" {LICENSE}", (), ()),
    ("mit", "x11", f" {LICENSE}", (), ()),
    ("bsd", "bsd", f" {LICENSE}", (), ()),
    ("bsd-2-clause", "bsd", f" 2 clause(?: {LICENSE})?", (), ()),
    ("bsd-3-clause", "bsd", f" 3 clause(?: {LICENSE})?", (), ()),
    ("bsd-2-clause", "simplified", f" bsd {LICENSE}", (), ()),
    ("bsd-2-clause", "2", f" clause bsd(?: {LICENSE})?", (), ()),
    ("bsd-3-clause", "3", f" clause bsd(?: {LICENSE})?", (), ()),
    ("bsd-3-clause", "new", f" bsd {LICENSE}", (), ()),
    ("bsd-4-clause", "original", f" bsd {LICENSE}", (), ()),
    ("cc0", "cc0", "", (), ("1.0",)),
]
CC_PARTS = {"by": "attribution", "by-sa": "attribution share ?alike", "by-nd": "attribution no ?deriv(?:ative)?s",
            "by-nc": "attribution non ?commercial", "by-nc-sa": "attribution non ?commercial share ?alike",
            "by-nc-nd": "attribution non ?commercial no ?deriv(?:ative)?s"}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
NOTICES = [
    ("permission", " is hereby granted free of charge to any person", "mit", 2, 0.95),
    ("redistribution", " and use in source and binary forms", "bsd", 2, 0.9),
    ("dedicated", " to the public domain", "public-domain", 2, 0.9),
    ("public", " domain", "public-domain", 3, 0.6),
    ("all", " rights reserved", "proprietary", 3, 0.5),
    ("copyright", " (?:c )?(?:1[89]|20)[0-9][0-9]", "copyright-notice", 4, 0.4),
    ("creative", f" commons(?: {LICENSE})?", "cc", 4, 0.6),
    ("licensed", " under", "license-reference", 4, 0.3),
    ("spdx", f" {LICENSE} identifier", "spdx-tag", 4, 0.5),
]


def _number(version: str) -> str:
    major, minor = version.split(".")
    return rf" v?{major}(?: {minor})?" if minor == "0" else rf" v?{major} {minor}"


def signature_rules() -> list[Rule]:
    """All rules in their order: exact tags, then names with a version, then bare names, then notices."""
    out: list[Rule] = []
    for label, first, rest, short, versions in FAMILIES:
        for v in versions:
            full = f"{label}-{v}"
            out.append(Rule(first, rf"{first}{rest}(?: version)?{_number(v)}(?: or(?: any)? later| only)?", full, 2, 0.95))
            for name in short:
                out.append(Rule(name, rf"{name}(?: version)?{_number(v)}(?: or(?: any)? later| only)?", full, 2, 0.9))
                out.append(Rule("spdx", rf"spdx {LICENSE} identifier {name}{_number(v)}(?: or later| only)?", full, 1, 1.0))
        out.append(Rule(first, first + rest, label, 3, 0.8))
        out.append(Rule("spdx", rf"spdx {LICENSE} identifier {label.replace('-', ' ')}", label, 1, 1.0))
    for part, words in CC_PARTS.items():
        for v in CC_VERSIONS:
            full, code = f"cc-{part}-{v}", part.replace("-", " ")
            major, minor = v.split(".")
            out.append(Rule("creative", rf"creative commons {words} {major} {minor}", full, 2, 0.95))
            out.append(Rule("cc", rf"cc {code} {major} {minor}", full, 2, 0.9))
            out.append(Rule("spdx", rf"spdx {LICENSE} identifier cc {code} {major} {minor}", full, 1, 1.0))
        out.append(Rule("creative", f"creative commons {words}", f"cc-{part}", 3, 0.8))
    out += [Rule(first, first + rest, label, tier, conf) for first, rest, label, tier, conf in NOTICES]
    return [Rule(r.trigger, f"^(?:{r.pattern})(?: |$)", r.label, r.tier, r.confidence) for r in out]


def gate_of(rules: list[Rule]) -> str:
    """A pattern on raw text that every match of a rule or a base phrase passes.

    It is the rules' own patterns with gaps for the single spaces, without those that begin with another
    one, tried only where a word begins and only among those of its first character.
    """
    patterns = sorted({r.pattern.removeprefix("^(?:").removesuffix(")(?: |$)") for r in rules} | set(BASE), key=lambda x: (len(x), x))
    least: list[str] = []
    for x in patterns:
        if not any(x == y or x.startswith((y + " ", y + "(?: ")) for y in least):
            least.append(x)
    by_first: dict[str, list[str]] = {}
    for x in least:
        by_first.setdefault(x[0], []).append(x[1:].replace(" ", GAP))
    firsts = "".join(sorted(by_first))
    each = "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in sorted(by_first.items()))
    return rf"(?i)(?=[{firsts}])(?<!{ANY_CASE_WORD.removesuffix('+')})(?:{each})"


def _rule_table(rules: list[Rule]) -> Column:
    return F.array(*[F.struct(F.lit(r.trigger).alias("trigger"), F.lit(r.pattern).alias("pattern"), F.lit(r.label).alias("label"),
                              F.lit(r.tier).alias("tier"), F.lit(i).alias("at"), F.lit(r.confidence).alias("conf"))
                     for i, r in enumerate(rules)])


def _base_label(words: Column, w: Column, i: Column) -> Column:
    def word(k: int) -> Column:
        return F.get(words, i + k)

    out = None
    for phrase, label in BASE.items():
        parts = phrase.split()
        hit = w == parts[0]
        for k, part in enumerate(parts[1:], 1):
            hit = hit & F.coalesce(word(k) == part, F.lit(False))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """(id, n_words, base, detections) for every row of ``docs``.

    ``base`` lists the places of the base phrases as (start, label), words from 0. ``detections`` lists
    what the rules found as (start, end, label, tier, at, conf), after suppression: a detection goes if
    its interval lies inside a longer one of the same or a stronger tier, or equals one of a stronger
    tier or an earlier rule.

    A null or empty text has no words, no places and no detections; long texts are scanned whole;
    repeated rows are separate documents; columns of other names are ignored.
    """
    rules = signature_rules() if rules is None else rules
    triggers = sorted({r.trigger for r in rules})
    most = max(sum(r.trigger == t for r in rules) for t in triggers)
    text = F.coalesce(F.col(text_col), F.lit(""))
    gated = docs.select(F.col(id_col).alias("id"), text.alias("text"), text.rlike(gate_of(rules)).alias("gate"))
    words = gated.select(
        "id", F.regexp_count("text", F.lit(ANY_CASE_WORD)).cast("bigint").alias("n_words"),
        F.when(F.col("gate"), F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(WORD), F.lit(0)))
        .otherwise(F.array().cast("array<string>")).alias("ws"))
    table = _rule_table(rules)
    is_trigger = F.array(*[F.lit(t) for t in triggers])

    def at_anchor(a: Column) -> Column:
        ahead = F.array_join(F.slice(F.col("ws"), a + 1, REACH), " ")
        first = F.get(F.col("ws"), a)
        return F.transform(
            F.filter(table, lambda r: (r["trigger"] == first) & F.rlike(ahead, r["pattern"])),
            lambda r: F.struct(
                a.alias("start"),
                (a + F.size(F.split(F.trim(F.regexp_substr(ahead, r["pattern"])), " "))).alias("end"),
                r["label"].alias("label"), r["tier"].alias("tier"), r["at"].alias("at"), r["conf"].alias("conf")))

    found = words.select(
        "id", "n_words",
        F.filter(F.transform("ws", lambda w, i: F.struct(i.alias("start"), _base_label(F.col("ws"), w, i).alias("label"))),
                 lambda x: x["label"].isNotNull()).alias("base"),
        F.flatten(F.transform(
            F.filter(F.transform("ws", lambda w, i: F.when(F.array_contains(is_trigger, w), i)), lambda a: a.isNotNull()),
            at_anchor)).alias("found"))
    # only detections that begin up to REACH words before or at the same word can hold another one
    near = REACH * most
    sorted_ = found.withColumn("found", F.array_sort("found"))

    def stands(x: Column, k: Column) -> Column:
        around = F.slice(F.col("found"), F.greatest(k + 1 - near, F.lit(1)), F.lit(2 * near))
        return ~F.exists(around, lambda y: (y["start"] <= x["start"]) & (y["end"] >= x["end"]) & (
            ((y["end"] - y["start"] > x["end"] - x["start"]) & (y["tier"] <= x["tier"]))
            | ((y["end"] - y["start"] == x["end"] - x["start"]) & (
                (y["tier"] < x["tier"]) | ((y["tier"] == x["tier"]) & (y["at"] < x["at"]))))))

    return sorted_.select("id", "n_words", "base", F.filter("found", stands).alias("detections")).withColumnRenamed("id", id_col)


def license_report(docs: DataFrame) -> DataFrame:
    """One row per document: counts and places of the base phrases, all labels, and the best confidence."""
    scanned = scan_licenses(docs)

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    base = F.transform("base", lambda x: x["label"])
    own = F.transform("detections", lambda x: x["label"])
    starts = F.transform("base", lambda x: x["start"])
    conf = F.transform("detections", lambda x: x["conf"])
    return scanned.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).cast("bigint").alias("first_word"), F.array_max(starts).cast("bigint").alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, own)).alias("labels"),
        F.coalesce(F.array_max(conf), F.lit(0.0)).alias("score"))
