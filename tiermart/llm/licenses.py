"""License scan by ordered signature rules.

A text is read as words (runs of letters, digits and non-ASCII characters,
A-Z lower-cased) joined by one space. Each rule is a regex over whole words
with a keyword, a label, a tier and a weight. A rule runs only on texts that
hold its keyword, and only texts with some keyword are looked at at all. Each
match is a span of words. A span is dropped if another span holds it whole and
is of the same or a stronger tier (longer span, or the same span and an
earlier rule); the base phrases' own places are never dropped. What follows a tag or a grant after "or", "and" or "with"
and is a license's name or tag is a detection as well (up to ``MOST_OPERANDS`` of one tag or grant).

Everything is built from column functions; a row is scanned where it lies, so
nothing is shuffled.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Base phrases and their labels (fixed values).
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# label, keyword, regex of the name in normalised words. Order is priority inside a tier.
NAMES = (
    ("agpl-3.0", "affero", r"(gnu )?affero general public licen[sc]e( (version|v) ?3( 0)?| v?3( 0)?)?( or later| only)?"),
    ("agpl-3.0", "agpl", r"(gnu )?agpl(v3| ?3( 0)?)?( or later| only)?"),
    ("lgpl-2.1", "lesser", r"(gnu )?lesser general public licen[sc]e( (version|v) ?2( 1)?| v?2( 1)?)?( or later| only)?"),
    ("lgpl-3.0", "lesser", r"(gnu )?lesser general public licen[sc]e( version| v)? ?3( 0)?( or later| only)?"),
    ("lgpl-2.0", "library general", r"(gnu )?library general public licen[sc]e( (version|v) ?2( 0)?)?"),
    ("lgpl", "lgpl", r"(gnu )?lgpl(v?[23]|( v?[23]))?( [01])?( or later| only)?"),
    ("gpl-3.0", "general public", r"(gnu )?general public licen[sc]e( version| v)? ?3( 0)?( or later| only)?"),
    ("gpl-2.0", "general public", r"(gnu )?general public licen[sc]e( version| v)? ?2( 0)?( or later| only)?"),
    ("gpl-1.0", "general public", r"(gnu )?general public licen[sc]e( version| v)? ?1( 0)?( or later| only)?"),
    ("gpl", "general public", r"(gnu )?general public licen[sc]e"),
    ("gpl-3.0", "gpl", r"(gnu )?gpl(v| v)?( ?3)( 0)?( or later| only)?"),
    ("gpl-2.0", "gpl", r"(gnu )?gpl(v| v)?( ?2)( 0)?( or later| only)?"),
    ("gfdl", "documentation", r"(gnu )?free documentation licen[sc]e( (version|v) ?1( [123])?)?"),
    ("apache-2.0", "apache", r"apache( software)? licen[sc]e( version| v)? ?2( 0)?"),
    ("apache-1.1", "apache", r"apache( software)? licen[sc]e( version| v)? ?1 1"),
    ("apache-1.0", "apache", r"apache( software)? licen[sc]e( version| v)? ?1( 0)?"),
    ("apache", "apache", r"apache( software)? licen[sc]e"),
    ("apache-2.0", "apache", r"apache 2( 0)?"),
    ("mit-0", "mit no", r"mit no attribution( licen[sc]e)?"),
    ("mit", "mit", r"mit( x11| expat)? licen[sc]e"),
    ("mit", "expat", r"expat licen[sc]e"),
    ("x11", "x11", r"x11 licen[sc]e"),
    ("bsd-4-clause", "bsd", r"(bsd 4 clause|4 clause bsd|original bsd)( original)?( licen[sc]e)?"),
    ("bsd-3-clause", "bsd", r"(bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)( new or revised)?( licen[sc]e)?"),
    ("bsd-2-clause", "bsd", r"(bsd 2 clause|2 clause bsd|simplified bsd|freebsd)( simplified)?( licen[sc]e)?"),
    ("0bsd", "bsd", r"(0bsd|zero clause bsd|bsd zero clause)( licen[sc]e)?"),
    ("bsd", "bsd", r"bsd( style| like)? licen[sc]e"),
    ("isc", "isc", r"isc licen[sc]e"),
    ("zlib", "zlib", r"zlib( libpng)? licen[sc]e"),
    ("libpng", "libpng", r"libpng licen[sc]e"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[sc]e( version| v)? ?2( 0)?"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[sc]e( version| v)? ?1 1"),
    ("mpl-1.0", "mozilla", r"mozilla public licen[sc]e( version| v)? ?1( 0)?"),
    ("mpl", "mozilla", r"mozilla public licen[sc]e"),
    ("mpl", "mpl", r"mpl (1 1|1 0|2 0|2)"),
    ("epl-2.0", "eclipse", r"eclipse public licen[sc]e( version| v)? ?2( 0)?"),
    ("epl-1.0", "eclipse", r"eclipse public licen[sc]e( version| v)? ?1( 0)?"),
    ("epl", "eclipse", r"eclipse public licen[sc]e"),
    ("edl-1.0", "eclipse", r"eclipse distribution licen[sc]e( v ?1 0| 1 0)?"),
    ("cddl-1.0", "development and distribution", r"common development and distribution licen[sc]e( (version|v) ?1( [01])?)?"),
    ("cddl", "cddl", r"cddl( 1 [01])?"),
    ("cpl-1.0", "common public", r"common public licen[sc]e( (version|v) ?(0 5|1 0))?"),
    ("cpal-1.0", "attribution", r"common public attribution licen[sc]e( (version|v) ?1 0)?"),
    ("ipl-1.0", "ibm", r"ibm public licen[sc]e"),
    ("eupl-1.2", "european", r"european union public licen[sc]e( (version|v) ?1 [012])?"),
    ("eupl", "eupl", r"eupl( (version|v) ?1 [012]| 1 [012])?"),
    ("artistic-2.0", "artistic", r"artistic licen[sc]e( version| v)? ?2( 0)?"),
    ("artistic-1.0", "artistic", r"(perl )?artistic licen[sc]e( version| v)? ?1( 0)?"),
    ("artistic", "artistic", r"artistic licen[sc]e"),
    ("bsl-1.0", "boost", r"boost software licen[sc]e( (version|v) ?1( 0)?)?"),
    ("busl-1.1", "business source", r"business source licen[sc]e( (version|v) ?1( 1)?| 1 1)?"),
    ("sspl-1.0", "server side", r"server side public licen[sc]e( (version|v) ?1( 0)?)?"),
    ("elastic-2.0", "elastic", r"elastic licen[sc]e( (version|v) ?2( 0)?| 2 0)?"),
    ("osl-3.0", "open software", r"open software licen[sc]e( (version|v) ?[123]( [01])?)?"),
    ("afl-3.0", "academic free", r"academic free licen[sc]e( (version|v) ?[123]( [012])?)?"),
    ("ecl-2.0", "educational", r"educational community licen[sc]e( (version|v) ?[12]( 0)?)?"),
    ("upl-1.0", "universal permissive", r"universal permissive licen[sc]e( (version|v) ?1 0)?"),
    ("unlicense", "unlicense", r"(the )?unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl( version 2| v2)?"),
    ("wtfpl", "what the", r"do what the [^ ]+ you want to public licen[sc]e"),
    ("cc0-1.0", "cc0", r"cc0( 1 0)?( universal)?"),
    ("cc-by-nc-nd", "commercial", r"creative commons attribution non ?commercial no ?deriv(ative)?s( works)?( [1-4] [05])?"),
    ("cc-by-nc-sa", "commercial", r"creative commons attribution non ?commercial share ?alike( [1-4] [05])?"),
    ("cc-by-nc", "commercial", r"creative commons attribution non ?commercial( [1-4] [05])?"),
    ("cc-by-nd", "creative commons", r"creative commons attribution no ?deriv(ative)?s( works)?( [1-4] [05])?"),
    ("cc-by-sa", "creative commons", r"creative commons attribution share ?alike( [1-4] [05])?"),
    ("cc-by", "creative commons", r"creative commons attribution( [1-4] [05])?"),
    ("cc", "creative commons", r"creative commons( licen[sc]e)?"),
    ("cc-by-nc-nd", "cc by", r"cc by nc nd( [1-4] [05])?"),
    ("cc-by-nc-sa", "cc by", r"cc by nc sa( [1-4] [05])?"),
    ("cc-by-nc", "cc by", r"cc by nc( [1-4] [05])?"),
    ("cc-by-nd", "cc by", r"cc by nd( [1-4] [05])?"),
    ("cc-by-sa", "cc by", r"cc by sa( [1-4] [05])?"),
    ("cc-by", "cc by", r"cc by( [1-4] [05])?"),
    ("odbl-1.0", "database", r"open (data commons open )?database licen[sc]e( (version|v) ?1( 0)?)?"),
    ("odbl-1.0", "odbl", r"odbl( 1 0)?"),
    ("odc-by-1.0", "odc", r"odc by( 1 0)?"),
    ("pddl-1.0", "public domain dedication", r"public domain dedication and licen[sc]e"),
    ("python-2.0", "python", r"python( software foundation)? licen[sc]e( (version|v) ?2( 0)?| 2 0)?"),
    ("python-2.0", "psf", r"psf licen[sc]e( (version|v) ?2( 0)?| 2 0)?"),
    ("php-3.01", "php", r"php licen[sc]e( (version|v) ?3( 01)?| 3 01)?"),
    ("ruby", "ruby", r"ruby licen[sc]e"),
    ("vim", "vim", r"vim licen[sc]e"),
    ("openssl", "openssl", r"openssl licen[sc]e"),
    ("postgresql", "postgresql", r"postgresql licen[sc]e"),
    ("ofl-1.1", "open font", r"(sil )?open font licen[sc]e( (version|v) ?1( [01])?| 1 1)?"),
    ("ms-pl", "microsoft", r"microsoft public licen[sc]e"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e"),
    ("ncsa", "ncsa", r"(university of illinois )?ncsa( open source)? licen[sc]e"),
    ("w3c", "w3c", r"w3c( software)?( notice and)? licen[sc]e"),
    ("qpl-1.0", "public", r"q public licen[sc]e( (version|v) ?1 0)?"),
    ("sleepycat", "sleepycat", r"sleepycat( public)? licen[sc]e"),
    ("zpl-2.1", "zope", r"zope public licen[sc]e( (version|v) ?[12]( [01])?)?"),
    ("apsl-2.0", "apple", r"apple public source licen[sc]e( (version|v) ?[12]( [012])?)?"),
    ("cecill-2.1", "cecill", r"cecill( free software)?( licen[sc]e)?( (version|v) ?[12]( [01])?)?"),
    ("mulan-psl-2.0", "mulan", r"mulan (permissive software licen[sc]e|psl)( v ?2| v2)?"),
    ("blueoak-1.0.0", "blue oak", r"blue oak model licen[sc]e( 1 0 0)?"),
    ("ntp", "ntp", r"ntp licen[sc]e"),
    ("curl", "curl", r"curl licen[sc]e"),
    ("tcl", "tcl", r"tcl tk licen[sc]e"),
    ("beerware", "beer", r"beer ?ware licen[sc]e"),
    ("openrail", "rail", r"(creativeml )?open ?rail( m)?( licen[sc]e)?"),
    ("llama", "llama", r"llama [0-9]*( ?[0-9])? ?community licen[sc]e( agreement)?"),
    ("public-domain", "public domain", r"(in|into|to) the public domain"),
)

# label, keyword, regex of whole notices.
NOTICES = (
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission to use", r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("mit-style", "without restriction", r"to deal in the software without restriction"),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms( with or without modification)?( are permitted)?"),
    ("bsd-3-clause", "neither the name", r"neither the name of( the)?( [^ ]+){1,8} nor the names of (its|their) contributors"),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software"),
    ("zlib", "express or implied", r"this software is provided as is without any express or implied warranty"),
    ("gpl", "free software", r"this (program|file|library|software) is free software( you can redistribute it( and or modify it)?)?"),
    ("apache-2.0", "apache", r"licensed under the apache license version 2 0 the license( you may not use this file)?"),
    ("mpl-2.0", "source code form", r"this source code form is subject to the terms of the mozilla public licen[sc]e( v 2 0| version 2 0)?"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("cc", "creativecommons", r"creativecommons org licenses(( (by|nc|nd|sa|sampling|devnations)){1,4}( [1-4] [015])?| [1-4] [05])"),
    ("cc0-1.0", "creativecommons", r"creativecommons org publicdomain zero 1 0"),
    ("apache-2.0", "apache", r"(www )?apache org licenses license 2 0( txt| html)?"),
    ("gpl", "gnu", r"(www )?gnu org licenses( gpl[0-9 ]*| lgpl[0-9 ]*| agpl[0-9 ]*)?( txt| html)?"),
    ("mit", "opensource", r"opensource org licenses mit( license)?( php| html)?"),
    ("bsd", "opensource", r"opensource org licenses bsd( [234] clause)?( licen[sc]e)?( php| html)?"),
    ("proprietary", "all rights", r"all rights reserved"),
    ("proprietary", "proprietary", r"proprietary and confidential"),
    ("proprietary", "unauthorized", r"unauthorized copying of this file"),
    ("warranty", "warrant", r"without warrant(y|ies) of any kind( (either )?express(ed)? or implied)?"),
)

# label, keyword, regex of short names that are licenses only where the words before say so.
SHORT = (
    ("mit", "mit", r"mit"), ("apache-2.0", "apache", r"apache 2( 0)?"), ("apache", "apache", r"apache"),
    ("gpl-3.0", "gpl", r"(gnu )?gpl ?v?3( 0)?"), ("gpl-2.0", "gpl", r"(gnu )?gpl ?v?2( 0)?"), ("gpl", "gpl", r"(gnu )?gpl"),
    ("lgpl", "lgpl", r"(gnu )?lgpl"), ("agpl", "agpl", r"(gnu )?agpl"), ("bsd-3-clause", "bsd", r"bsd 3 clause"),
    ("bsd-2-clause", "bsd", r"bsd 2 clause"), ("bsd", "bsd", r"bsd"), ("isc", "isc", r"isc"), ("zlib", "zlib", r"zlib"),
    ("mpl-2.0", "mpl", r"mpl 2( 0)?"), ("mpl", "mpl", r"mpl"), ("epl", "epl", r"epl"), ("bsl-1.0", "bsl", r"bsl 1( 0)?"),
    ("cc0-1.0", "cc0", r"cc0"), ("unlicense", "unlicense", r"unlicense"), ("wtfpl", "wtfpl", r"wtfpl"),
)
_GRANTED = r"(licen[sc]ed|released|distributed|available|published|provided) under( the| a)?( terms( and conditions)? of( the)?)?"
_OPERATORS = ("or", "and", "with")
MOST_OPERANDS = 16  # of one tag or grant

TIERS = {"tag": (1, 1.0), "grant": (2, 0.95), "notice": (2, 0.9), "name": (3, 0.7)}


def _spelled(label: str) -> str:
    """A label as normalised words."""
    return label.replace("-", " ").replace(".", " ")


def operand_names() -> list[dict]:
    """Words that stand for a license as a further operand of a tag or grant, longest first."""
    plain = {label: label for label in {n[0] for n in NAMES}} | {
        "apache-2": "apache-2.0", "gnu-gpl": "gpl", "gplv2": "gpl-2.0", "gplv3": "gpl-3.0", "gnu-lgpl": "lgpl", "agpl": "agpl-3.0",
        "zlib-libpng": "zlib", "epl": "epl", "the-unlicense": "unlicense"} | {n[0]: n[0] for n in SHORT}
    return [{"words": _spelled(name).split(), "label": label}
            for name, label in sorted(plain.items(), key=lambda x: (-len(_spelled(x[0]).split()), x))]


def rules() -> list[dict]:
    """The ordered rules: each name as an SPDX tag, as a grant and alone, short names where the words before call for a
    license, and the notices."""
    out = []
    for label, keyword, name in NAMES:
        out.append((label, "licen", rf"spdx licen[sc]e identifier {_spelled(label)}( or later| only)?", "tag"))
        out.append((label, keyword, rf"(dual |re ?)?(licen[sc]ed|released|distributed|available|published|provided) "
                                    rf"(under|by|with)( the| a)?( terms( and conditions)? of( the)?)? {name}", "grant"))
    for label, keyword, name in SHORT:
        out.append((label, keyword, rf"(licen[sc]e( is)?|{_GRANTED}) {name}( or later| only)?", "grant"))
    out += [(label, keyword, regex, "notice") for label, keyword, regex in NOTICES]
    out += [(label, keyword, regex, "name") for label, keyword, regex in NAMES]
    seen, ordered = set(), []
    for label, keyword, regex, kind in out:
        if regex not in seen:
            seen.add(regex)
            tier, weight = TIERS[kind]
            ordered.append({"n": len(ordered), "label": label, "keyword": keyword, "tier": tier, "weight": weight,
                            "regex": rf"(?<![^ ])(?:{regex})(?![^ ])"})
    return ordered


# A text without any of these holds no match of any rule.
GATES = ("licen", "gpl", "apache", "bsd", "attribution", "mpl", "cddl", "eupl", "wtfpl", "cc0", "creative", "cc by", "odbl",
         "odc", "public domain", "rail", "mulan", "cecill", "permission", "restriction", "redistribution", "neither the name",
         "advertising materials", "express", "free software", "source code form", "unencumbered", "gnu", "opensource",
         "rights reserved", "proprietary", "unauthorized", "warrant", "released under", "distributed under", "available under",
         "published under", "provided under")

RULE_TYPE = "array<struct<n int, label string, keyword string, tier int, weight double, regex string>>"
SPAN_TYPE = "array<struct<first int, last int, tier int, n int, label string, weight double>>"
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # between words while upper case is still there
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def gated(lowered: Column) -> Column:
    """True where some rule can match: every match holds one of GATES."""
    out = F.lit(False)
    for g in GATES:
        out = out | F.contains(lowered, F.lit(g))
    return out


def _rule_spans(words: Column, norm: Column, rule: Column) -> Column:
    """Spans of one rule's matches; each match's first word is marked to find where it stands."""
    marked = F.split(F.regexp_replace(norm, F.concat(F.lit("("), rule["regex"], F.lit(")")), F.lit("\x01$1")), " ", -1)
    starts = F.array_compact(F.transform(marked, lambda w, i: F.when(w.startswith("\x01"), i)))
    found = F.regexp_extract_all(norm, F.concat(F.lit("("), rule["regex"], F.lit(")")), F.lit(1))
    return F.zip_with(starts, found, lambda s, m: F.struct(
        s.alias("first"), (s + F.length(m) - F.length(F.replace(m, F.lit(" "), F.lit("")))).alias("last"),
        rule["tier"].alias("tier"), rule["n"].alias("n"), rule["label"].alias("label"), rule["weight"].alias("weight")))


def _operands(words: Column, spans: Column, names: Column) -> Column:
    """Spans of the licenses that follow a tag or grant after "or", "and" or "with": each operand is a span of its own."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN_TYPE).alias("found"))

    def following(s: Column) -> Column:
        def step(acc: Column, _: Column) -> Column:
            at = acc["at"] + F.when(F.get(words, acc["at"] + 1) == "the", 2).otherwise(1)
            name = F.get(F.filter(names, lambda n: F.slice(words, at + 1, F.size(n["words"])) == n["words"]), F.lit(0))
            last = at + F.size(name["words"]) - 1
            more = F.struct((last + 1).alias("at"), F.concat(acc["found"], F.array(F.struct(
                at.alias("first"), last.alias("last"), s["tier"].alias("tier"), s["n"].alias("n"), name["label"].alias("label"),
                s["weight"].alias("weight")))).cast(SPAN_TYPE).alias("found"))
            # An exception's name after "with" is no license; the expression may go on after its few words.
            on = F.array_min(F.filter(F.sequence(acc["at"] + 2, acc["at"] + 5), lambda j: F.get(words, j).isin(*_OPERATORS)))
            past = F.struct(F.coalesce(F.when(F.get(words, acc["at"]) == "with", on), acc["at"]).alias("at"), acc["found"].alias("found"))
            return F.when(F.get(words, acc["at"]).isin(*_OPERATORS), F.when(name.isNotNull(), more).otherwise(past)).otherwise(acc)
        begin = F.struct((s["last"] + 1).alias("at"), start["found"].alias("found"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(MOST_OPERANDS)), begin, step, lambda acc: acc["found"])
    calling = F.filter(spans, lambda s: (s["tier"] <= TIERS["grant"][0]) & (s["weight"] >= TIERS["grant"][1]))
    return F.flatten(F.transform(calling, following))


def _suppressed(spans: Column) -> Column:
    """Spans that no other span of the same or a stronger tier holds whole, in order of first word.

    One sweep: in order of first word, longer spans, stronger tiers and earlier rules first, a span that holds another
    comes before it, so the furthest end so far among the tiers that count tells.
    """
    tiers = sorted({t for t, _ in TIERS.values()})
    ranked = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["first"].alias("first"), (-s["last"]).alias("neg"), s["tier"].alias("tier"), s["n"].alias("n"), s.alias("span"))))
    begin = F.struct(*[F.lit(-1).alias(f"to{t}") for t in tiers], F.array().cast(SPAN_TYPE).alias("kept"))

    def step(acc: Column, r: Column) -> Column:
        s = r["span"]
        reached = F.coalesce(*[F.when(s["tier"] == t, acc[f"to{t}"]) for t in tiers])
        return F.struct(
            *[F.when(s["tier"] <= t, F.greatest(acc[f"to{t}"], s["last"])).otherwise(acc[f"to{t}"]).alias(f"to{t}") for t in tiers],
            F.when(reached >= s["last"], acc["kept"]).otherwise(F.concat(acc["kept"], F.array(s))).alias("kept"))
    return F.aggregate(ranked, begin, step, lambda acc: acc["kept"])


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_words, spans (kept detections), base (array of word index and label).

    Null and empty texts have no words and no spans; spans are in order of first
    word. Repeated rows each get a row; no rows give none.
    """
    catalogue = rules()
    known = F.from_json(F.lit(json.dumps(catalogue)), RULE_TYPE)
    words = F.coalesce(F.trim(F.regexp_replace(F.col(f"`{text}`"), _GAP, " ")), F.lit(""))
    read = docs.select(F.col(f"`{key}`"), words.alias("__plain"))
    read = read.withColumn("__gate", gated(F.lower("__plain")))
    none = F.array().cast(SPAN_TYPE)
    read = read.select(
        F.col(f"`{key}`"),
        F.when(F.col("__plain") == "", F.lit(0)).otherwise(
            F.length("__plain") - F.length(F.replace("__plain", F.lit(" "), F.lit(""))) + 1).cast("long").alias("n_words"),
        F.when(F.col("__gate"), F.translate(F.col("__plain"), _UPPER, _LOWER)).alias("__norm"))
    read = read.withColumn("__words", F.split("__norm", " ", -1))
    norm = F.col("__norm")
    hits = F.filter(known, lambda r: F.contains(norm, r["keyword"]))
    read = read.withColumn("__spans", F.when(norm.isNull(), none).otherwise(
        F.flatten(F.transform(hits, lambda r: _rule_spans(F.col("__words"), norm, r))).cast(SPAN_TYPE)))
    names = F.from_json(F.lit(json.dumps(operand_names())), "array<struct<words array<string>, label string>>")
    read = read.withColumn("__spans", F.concat("__spans", _operands(F.col("__words"), F.col("__spans"), names)))
    base_type = "array<struct<first:int,label:string>>"

    def places(phrase: str, label: str) -> Column:
        parts = phrase.split()
        at = F.transform("__words", lambda w, i: F.when(w == parts[0], i))
        ok = F.filter(F.array_compact(at), lambda i: _all(
            [F.get("__words", i + k) == part for k, part in enumerate(parts[1:], 1)]))
        return F.transform(ok, lambda i: F.struct(i.alias("first"), F.lit(label).alias("label")))

    base = F.when(norm.isNull(), F.array().cast(base_type)).otherwise(
        F.sort_array(F.concat(*[places(*b) for b in BASE])).cast(base_type))
    return read.select(F.col(f"`{key}`"), "n_words", base.alias("base"),
                       F.sort_array(_suppressed(F.col("__spans"))).alias("spans"))


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & F.coalesce(c, F.lit(False))
    return out
