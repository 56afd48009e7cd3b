"""License scans: ordered signature rules over the words of a text, in DataFrame functions.

A text is brought to lower-case words joined by blanks. A few hints decide whether any rule
can apply, a rule's own keyword whether its regex is tried. Detections are swept in order of
their places: one that lies inside another of the same or a higher priority is dropped.
Everything is an expression on one row, so nothing is shuffled.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phrases whose places are always told, and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Priorities: a full name with a version, a name, a clause or hint.
EXACT, NAMED, CLUE = 2, 1, 0
WEIGHTS = {EXACT: 1.0, NAMED: 0.8, CLUE: 0.4}


@dataclass(frozen=True)
class Rule:
    """A label, the text that must occur for the regex to be tried, and the regex itself."""

    label: str
    keyword: str
    regex: str
    priority: int


def _gnu() -> list[Rule]:
    kinds = {
        "gpl": "general public license", "lgpl": "(?:lesser|library) general public license",
        "agpl": "affero general public license",
    }
    versions = {"gpl": ("1", "2", "3"), "lgpl": ("2", "2 1", "3"), "agpl": ("1", "3")}
    out = []
    for kind, name in kinds.items():
        keyword = name.rsplit(") ")[-1]
        for v in versions[kind]:
            short = v.replace(" ", ".")
            exact = v if v in ("2 1",) else f"{v}(?: 0)?"
            body = f"(?:gnu )?{name} (?:as published by the free software foundation )?(?:either )?(?:version |v ?)"
            out += [
                Rule(f"{kind}-{short}-or-later", keyword,
                     f"{body}{exact} (?:of the license )?or (?:at your option )?(?:any )?later(?: version)?", EXACT),
                Rule(f"{kind}-{short}-only", keyword, f"{body}{exact} only", EXACT),
                Rule(f"{kind}-{short}", keyword, f"{body}{exact}", EXACT),
                Rule(f"{kind}-{short}", kind, f"(?:gnu )?{kind} ?(?:version |v ?)?{exact}", EXACT),
                Rule(f"{kind}-{short}-or-later", kind, f"{kind} {exact} or later", EXACT),
                Rule(f"{kind}-{short}-only", kind, f"{kind} {exact} only", EXACT),
            ]
        out += [Rule(kind, keyword, f"(?:gnu )?{name}", NAMED),
                Rule(kind, f" {kind} ", f"(?:under|licensed|license) (?:the )?(?:gnu )?{kind}", NAMED)]
    for v in ("1 1", "1 2", "1 3"):
        out.append(Rule(f"gfdl-{v.replace(' ', '.')}", "free documentation license",
                        f"(?:gnu )?free documentation license version {v}", EXACT))
    out.append(Rule("gfdl", "free documentation license", "(?:gnu )?free documentation license", NAMED))
    return out


def _creative_commons() -> list[Rule]:
    words = {"by": "attribution", "sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?(?: works)?"}
    out = []
    for parts in (("by",), ("by", "sa"), ("by", "nc"), ("by", "nd"), ("by", "nc", "sa"), ("by", "nc", "nd")):
        label, short = "cc-" + "-".join(parts), "cc " + " ".join(parts)
        long = " ".join(words[p] for p in parts)
        for v in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            told = f"{label}-{v.replace(' ', '.')}"
            out += [
                Rule(told, "cc by", f"{short} {v}(?: (?:international|unported|deed))?", EXACT),
                Rule(told, "creative commons",
                     f"creative commons {long} {v}(?: (?:international|unported|generic))?(?: public)?(?: license)?", EXACT),
            ]
        out += [Rule(label, "cc by", short, NAMED),
                Rule(label, "creative commons", f"creative commons {long}(?: license)?", NAMED)]
    return [*out, Rule("cc0-1.0", "cc0", "cc0 1 0(?: universal)?", EXACT), Rule("cc0", "cc0", "cc0", NAMED),
            Rule("cc", "creative commons", "creative commons(?: license)?", CLUE)]


def _versioned() -> list[Rule]:
    """Licences told by a name and a version: label, keyword, regex of the name, versions."""
    table = (
        ("apache", "apache", "apache(?: software)? licen[sc]e", "1 0|1 1|2 0"),
        ("mpl", "mozilla", "mozilla public licen[sc]e", "1 0|1 1|2 0"),
        ("epl", "eclipse", "eclipse public licen[sc]e", "1 0|2 0"),
        ("eupl", "european union", "european union public licen[sc]e", "1 0|1 1|1 2"),
        ("cddl", "common development", "common development and distribution licen[sc]e", "1 0|1 1"),
        ("cpl", "common public", "common public licen[sc]e", "0 5|1 0"),
        ("osl", "open software", "open software licen[sc]e", "1 0|1 1|2 0|2 1|3 0"),
        ("afl", "academic free", "academic free licen[sc]e", "1 1|1 2|2 0|2 1|3 0"),
        ("artistic", "artistic", "(?:perl )?artistic licen[sc]e", "1 0|2 0"),
        ("bsl", "boost", "boost software licen[sc]e", "1 0"),
        ("busl", "business source", "business source licen[sc]e", "1 0|1 1"),
        ("ofl", "open font", "(?:sil )?open font licen[sc]e", "1 0|1 1"),
        ("odbl", "open database", "open database licen[sc]e", "1 0"),
        ("odc-by", "open data commons", "open data commons attribution licen[sc]e", "1 0"),
        ("pddl", "public domain dedication", "(?:open data commons )?public domain dedication and licen[sc]e", "1 0"),
        ("psf", "python", "python(?: software foundation)? licen[sc]e", "1 6|2 0|2 1|2 2|3"),
        ("php", "php", "php licen[sc]e", "3 0|3 01"),
        ("qpl", "q public", "q public licen[sc]e", "1 0"),
        ("rpl", "reciprocal", "reciprocal public licen[sc]e", "1 1|1 5"),
        ("sspl", "server side", "server side public licen[sc]e", "1"),
        ("upl", "universal permissive", "universal permissive licen[sc]e", "1 0"),
        ("zpl", "zope", "zope public licen[sc]e", "1 1|2 0|2 1"),
        ("lppl", "latex", "latex project public licen[sc]e", "1 0|1 1|1 2|1 3|1 3a|1 3c"),
        ("cecill", "cecill", "cecill(?: free software licen[sc]e)?", "1 0|1 1|2 0|2 1"),
        ("ms-pl", "microsoft public", "microsoft public licen[sc]e", "1 0"),
        ("ms-rl", "microsoft reciprocal", "microsoft reciprocal licen[sc]e", "1 0"),
        ("npl", "netscape", "netscape public licen[sc]e", "1 0|1 1"),
        ("apsl", "apple public", "apple public source licen[sc]e", "1 0|1 1|1 2|2 0"),
        ("ipl", "ibm public", "ibm public licen[sc]e", "1 0"),
        ("spl", "sun public", "sun public licen[sc]e", "1 0"),
        ("ecl", "educational community", "educational community licen[sc]e", "1 0|2 0"),
        ("ogl", "open government", "open government licen[sc]e", "1 0|2 0|3 0"),
        ("cdla-permissive", "community data", "community data licen[sc]e agreement permissive", "1 0|2 0"),
        ("cdla-sharing", "community data", "community data licen[sc]e agreement sharing", "1 0"),
        ("openrail", "rail", "(?:creativeml )?(?:bigscience )?open ?rail m? ?licen[sc]e", "1 0"),
    )
    out = []
    for label, keyword, name, versions in table:
        for v in versions.split("|"):
            loose = v.removesuffix(" 0") + "(?: 0)?" if v.endswith(" 0") else v
            out.append(Rule(f"{label}-{v.replace(' ', '.')}", keyword,
                            f"{name} (?:version |v ?)?{loose}", EXACT))
        out.append(Rule(label, keyword, name, NAMED))
    return out


def _others() -> list[Rule]:
    """Licences without a version, and the clauses by which texts are told."""
    named = (
        ("mit", "mit licen", "(?:the )?mit licen[sc]e"), ("mit-0", "mit no attribution", "mit no attribution"),
        ("mit", "expat", "expat licen[sc]e"), ("x11", "x11", "x11 licen[sc]e"),
        ("isc", "isc licen", "(?:the )?isc licen[sc]e"), ("zlib", "zlib", "zlib(?: libpng)? licen[sc]e"),
        ("libpng", "libpng", "libpng licen[sc]e"), ("bzip2", "bzip2", "bzip2 licen[sc]e"),
        ("bsd-0-clause", "bsd", "(?:0|zero) clause bsd|bsd (?:0|zero) clause(?: licen[sc]e)?"),
        ("bsd-1-clause", "bsd", "(?:1|one) clause bsd|bsd (?:1|one) clause(?: licen[sc]e)?"),
        ("bsd-2-clause", "bsd", "(?:simplified|freebsd|2 clause|two clause) bsd(?: licen[sc]e)?|bsd (?:2|two) clause(?: licen[sc]e)?"),
        ("bsd-3-clause", "bsd", "(?:new|modified|revised|3 clause|three clause) bsd(?: licen[sc]e)?|bsd (?:3|three) clause(?: licen[sc]e)?"),
        ("bsd-4-clause", "bsd", "(?:original|old|4 clause|four clause) bsd(?: licen[sc]e)?|bsd (?:4|four) clause(?: licen[sc]e)?"),
        ("bsd", "bsd", "bsd(?: style)? licen[sc]e"), ("unlicense", "unlicense", "(?:the )?unlicense"),
        ("wtfpl", "wtfpl", "wtfpl"), ("wtfpl", "do what the", "do what the f[a-z]* you want to public licen[sc]e"),
        ("beerware", "beer", "beer ?ware licen[sc]e"), ("postgresql", "postgresql", "postgresql licen[sc]e"),
        ("openssl", "openssl", "openssl licen[sc]e"), ("curl", "curl", "curl licen[sc]e"),
        ("icu", "icu", "icu licen[sc]e"), ("unicode", "unicode", "unicode(?: data files and software)? licen[sc]e"),
        ("ncsa", "ncsa", "(?:university of illinois )?ncsa open source licen[sc]e"), ("vim", "vim", "vim licen[sc]e"),
        ("ruby", "ruby", "ruby licen[sc]e"), ("w3c", "w3c", "w3c software (?:notice and )?licen[sc]e"),
        ("sleepycat", "sleepycat", "sleepycat licen[sc]e"), ("tcl", "tcl", "tcl(?: tk)? licen[sc]e"),
        ("json", "json", "json licen[sc]e"), ("ibpl", "interbase", "interbase public licen[sc]e"),
        ("mulan", "mulan", "mulan (?:psl|permissive software licen[sc]e)"), ("elastic", "elastic", "elastic licen[sc]e"),
        ("commons-clause", "commons clause", "commons clause(?: licen[sc]e condition)?"),
        ("llama", "llama", "llama [0-9 ]*community licen[sc]e"), ("gemma", "gemma", "gemma terms of use"),
        ("public-domain", "public domain", "(?:released|placed|dedicated|is) (?:in|into|to) the public domain"),
        ("proprietary", "proprietary", "proprietary and confidential|proprietary licen[sc]e"),
    )
    clauses = (
        ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy"),
        ("isc", "permission to use copy modify", "permission to use copy modify and or distribute this software for any purpose"),
        ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted"),
        ("bsd-3-clause", "neither the name of", "neither the name of .{1,80}? nor the names of its contributors may be used"),
        ("bsd-4-clause", "all advertising materials", "all advertising materials mentioning features or use of this software must display"),
        ("apache", "licensed under the apache", "licensed under the apache"),
        ("apache-2.0", "you may not use this file except in compliance", "you may not use this file except in compliance with the license"),
        ("mpl", "this source code form is subject to the terms", "this source code form is subject to the terms of the mozilla public license"),
        ("zlib", "this software is provided as is", "this software is provided as is without any express or implied warranty"),
        ("no-warranty", "without warranty", "without warranty of any kind"),
        ("no-warranty", "without any warranty", "without any warranty"),
        ("permission", "reprinted with permission", "reprinted with permission"),
        ("permission", "used by permission", "used by permission"),
        ("restricted", "not for commercial use", "not for commercial use"),
        ("restricted", "no part of this", "no part of this (?:publication|work|book|document) may be reproduced"),
        ("restricted", "do not distribute", "do not (?:copy or )?distribute"),
        ("copyright", "copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]"),
        ("spdx", "spdx license identifier", "spdx license identifier"),
        ("license", "licensed under", "licensed under"), ("license", "license agreement", "license agreement"),
        ("license", "terms of the license", "terms of the license"),
    )
    return [*(Rule(*x, NAMED) for x in named), *(Rule(*x, CLUE) for x in clauses)]


RULES = [*_gnu(), *_creative_commons(), *_versioned(), *_others()]
#: Every rule's keyword or regex needs one of these, and so does every base phrase.
HINTS = ("licen", "gpl", "cc by", "cc0", "creative commons", "copyright", "reserved", "public domain",
         "wtfpl", "bsd", "cecill", "mulan", "permission", "permitted", "warranty", "proprietary",
         "commons clause", "no attribution", "nor the names", "advertising materials", "commercial use",
         "may be reproduced", "distribute", "gemma terms")


#: Marks around a match, and detections that are looked at in a row.
OPENS, CLOSES = "\x01", "\x02"
BLOCK = 256


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _places(words: Column, phrase: str) -> list[Column]:
    """How often a phrase stands in ``words``, and where it first and last starts."""
    parts = F.split(words, f"(?<= ){phrase}(?= )", -1)
    n = F.size(parts) - 1
    first = _blanks(F.element_at(parts, 1)) - 1
    last = _blanks(words) - _blanks(F.element_at(parts, -1)) - phrase.count(" ") - 1
    return [F.when(F.coalesce(F.contains(words, F.lit(f" {phrase} ")), F.lit(False)), x).otherwise(other)
            for x, other in ((n, F.lit(0)), (F.when(n > 0, first), F.lit(None)), (F.when(n > 0, last), F.lit(None)))]


def _detections(words: Column) -> Column:
    """All places of all rules whose keyword occurs, in words: [start, end)."""
    rules = F.array(*[
        F.struct(F.lit(r.label).alias("label"), F.lit(r.keyword).alias("keyword"),
                 F.lit(f"(?<= )(?:{r.regex})(?= )").alias("regex"), F.lit(r.priority).alias("priority"))
        for r in RULES])

    # Words never hold these two, so a marked text tells which words a match begins and ends.
    marked = F.transform(F.filter(rules, lambda r: F.contains(words, r["keyword"])), lambda r: F.struct(
        r["label"].alias("label"), (-r["priority"]).alias("rank"),
        F.regexp_replace(words, r["regex"], F.lit(f"{OPENS}$0{CLOSES}")).alias("text")))

    def spans(rule: Column) -> Column:
        """Each step reads what the one before made, once: linear in words and matches."""
        tokens = F.transform(F.array(rule["text"]), lambda t: F.transform(
            F.split(t, " ", -1), lambda w, i: F.struct(
                w.startswith(OPENS).alias("first"), w.endswith(CLOSES).alias("last"), i.alias("i"))))
        ends = F.transform(tokens, lambda t: F.arrays_zip(
            F.transform(F.filter(t, lambda w: w["first"]), lambda w: w["i"]).alias("a"),
            F.transform(F.filter(t, lambda w: w["last"]), lambda w: w["i"]).alias("b")))
        # The text begins with a blank, so word k is token k + 1.
        return F.transform(F.flatten(ends), lambda p: F.struct(
            (p["a"] - 1).alias("start"), (-p["b"]).alias("back"), rule["rank"].alias("rank"),
            rule["label"].alias("label")))

    found = F.filter(marked, lambda r: F.contains(r["text"], F.lit(OPENS)))
    return F.array_sort(F.flatten(F.transform(found, spans)))


_KIND = "array<struct<start:int,back:int,rank:int,label:string>>"


def _outermost(found: Column) -> Column:
    """Detections that lie in no other one of their priority or a higher one.

    They come by start, the longer first, the higher priority first, so whatever holds a
    detection comes before it: the farthest end so far of each priority is enough.
    """
    reach = [f"e{p}" for p in (CLUE, NAMED, EXACT)]
    none = F.expr(f"CAST(array() AS {_KIND})").alias("kept")

    def step(acc: Column, x: Column) -> Column:
        end = -x["back"]
        own = F.when(x["rank"] == -CLUE, acc["e0"]).when(x["rank"] == -NAMED, acc["e1"]).otherwise(acc["e2"])
        ends = [F.when(-x["rank"] >= p, F.greatest(acc[e], end)).otherwise(acc[e]).alias(e)
                for p, e in zip((CLUE, NAMED, EXACT), reach, strict=True)]
        kept = F.when(own >= end, acc["kept"]).otherwise(F.array_append(acc["kept"], x))
        return F.struct(*ends, kept.alias("kept"))

    def block(acc: Column, part: Column) -> Column:
        """A block's detections join the others at once: an array is copied to grow."""
        start = F.struct(*[acc[e].alias(e) for e in reach], none)
        return F.aggregate(part, start, step, lambda done: F.struct(
            *[done[e].alias(e) for e in reach], F.array_append(acc["kept"], done["kept"]).alias("kept")))

    blocks = F.transform(F.array(found), lambda all_: F.transform(
        F.sequence(F.lit(0), F.floor(F.size(all_) / BLOCK).cast("int")),
        lambda k: F.slice(all_, k * BLOCK + 1, BLOCK)))
    top = F.struct(*[F.lit(-1).alias(e) for e in reach], F.expr(f"CAST(array() AS array<{_KIND}>)").alias("kept"))
    return F.aggregate(F.flatten(blocks), top, block, lambda acc: F.flatten(acc["kept"]))


def scan(docs: DataFrame, *, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, n_words, base places and labels, and the detections that stay.

    ``detections``: start, end (words), priority and label. A null or empty text has no
    words, no places and score 0. Each row by itself; columns of other names are left out.
    """
    bare = F.btrim(F.regexp_replace(F.coalesce(F.col(f"`{text}`"), F.lit("")), NOT_WORD, " "))
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], bare.alias("__bare"))
    low = F.lower("__bare")
    hinted = F.lit(False)
    for h in HINTS:
        hinted = hinted | F.contains(F.col("__low"), F.lit(h))
    # Only ASCII letters are lower-cased in what is looked at; `lower` serves as the hint.
    rows = rows.withColumn("__low", low).select(
        "*", F.when(hinted, F.concat(F.lit(" "), F.translate(
            "__bare", string.ascii_uppercase, string.ascii_lowercase), F.lit(" "))).alias("__words"))
    rows = rows.select(
        *[F.col(f"`{c}`") for c in keep], "__words",
        F.when(F.col("__bare") == "", F.lit(0)).otherwise(_blanks(F.col("__bare")) + 1).cast("long").alias("n_words"),
        *[F.struct(*[x.cast("long").alias(n) for x, n in zip(_places(F.col("__words"), phrase), "nfl", strict=True)]).alias(f"__b{k}")
          for k, (phrase, _) in enumerate(BASE)],
        F.when(F.col("__words").isNotNull(), _outermost(_detections(F.col("__words")))).alias("__found"))
    base = [F.col(f"__b{k}") for k in range(len(BASE))]
    labels = F.array_compact(F.array(*[F.when(b["n"] > 0, F.lit(label)) for b, (_, label) in zip(base, BASE, strict=True)]))
    found = F.coalesce("__found", F.expr(f"CAST(array() AS {_KIND})"))
    weight = F.transform(found, lambda x: F.when(x["rank"] == -EXACT, WEIGHTS[EXACT]).when(
        x["rank"] == -NAMED, WEIGHTS[NAMED]).otherwise(WEIGHTS[CLUE]))
    return rows.select(
        *[F.col(f"`{c}`") for c in keep], "n_words", sum((b["n"] for b in base), F.lit(0)).cast("long").alias("n_base"),
        F.least(*[b["f"] for b in base]).alias("first_word"), F.greatest(*[b["l"] for b in base]).alias("last_word"),
        F.array_sort(labels).alias("base_labels"),
        F.array_sort(F.array_distinct(F.concat(labels, F.transform(found, lambda x: x["label"])))).alias("labels"),
        F.greatest(F.coalesce(F.array_max(weight), F.lit(0.0)),
                   F.when(F.size(labels) > 0, F.lit(WEIGHTS[CLUE])).otherwise(F.lit(0.0))).alias("score"),
        F.transform(found, lambda x: F.struct(
            x["start"].alias("start"), (-x["back"]).alias("end"), (-x["rank"]).alias("priority"),
            x["label"].alias("label"))).alias("detections"))
