"""License scan by ordered signature rules, as column expressions only.

The text is reduced to its words (ASCII separators, A-Z lower-cased) joined by single spaces. Each
rule is a regex over these words with a keyword that every match of it has at a word's start; one keyword regex decides whether a text is looked
at further, and only rules whose keyword is in it run. A rule marks its matches in the word string,
so the marked words' numbers are its spans. Spans of all rules are then put in order, and one that
lies inside a span of the same or a higher priority is dropped; the labels of the rest are reported.
Everything happens in the row: no shuffle, no join, and work in proportion to the text.

Defined cases: a null or empty text has no words, no labels and score 0; rows are independent, so
repeated rows and rows that share an id give their own results, and an empty table gives an empty one; of equal spans of one
priority (a tie) the label that comes first in the alphabet stays; texts are scanned whole; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import ASCII_UPPER, ascii_lower

#: Separators between words, and the phrases that are always reported.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: label, keyword (words that every match holds, the last one perhaps cut short), regex of the name, SPDX identifier's words ("" where there is none).
NAMES = [
    ("mit", "mit", r"(?:the )?mit (?:x11 )?licen[cs]e", "mit"),
    ("mit-0", "mit", r"mit no attribution(?: licen[cs]e)?", "mit 0"),
    ("x11", "x11 licen", r"x11 licen[cs]e", "x11"),
    ("apache-1", "apache", r"apache (?:software )?licen[cs]e (?:version )?1(?: [01])?", "apache 1 [01]"),
    ("apache-2", "apache", r"apache (?:software )?licen[cs]e(?: version)? ?v?2(?: 0)?", "apache 2 0"),
    ("apache", "apache", r"apache (?:software )?licen[cs]e", ""),
    ("bsd-2", "bsd", r"(?:simplified|2 clause|two clause|freebsd) bsd(?: licen[cs]e)?|bsd (?:2|two) clause(?: licen[cs]e)?", "bsd 2 clause"),
    ("bsd-3", "bsd", r"(?:new|modified|revised|3 clause|three clause) bsd(?: licen[cs]e)?|bsd (?:3|three) clause(?: licen[cs]e)?", "bsd 3 clause"),
    ("bsd-4", "bsd", r"(?:original|4 clause|four clause) bsd(?: licen[cs]e)?|bsd (?:4|four) clause(?: licen[cs]e)?", "bsd 4 clause"),
    ("bsd-0", "bsd", r"zero clause bsd(?: licen[cs]e)?", ""),
    ("bsd-0", "0bsd", r"0bsd", "0bsd"),
    ("bsd", "bsd", r"bsd (?:style )?licen[cs]e", ""),
    ("isc", "isc licen", r"isc licen[cs]e", "isc"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e", "zlib"),
    ("libpng", "libpng licen", r"libpng licen[cs]e(?: version 2)?", "libpng(?: 2 0)?"),
    ("boost-1", "boost software licen", r"boost software licen[cs]e(?: version)?(?: 1(?: 0)?)?", "bsl 1 0"),
    ("unlicense", "unlicense", r"the unlicense", "unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl(?: version 2)?", "wtfpl"),
    ("public-domain", "public domain", r"(?:in|into|to) the public domain|public domain dedication", ""),
    ("gpl-1", "gnu general public licen", r"gnu general public licen[cs]e(?: version| v)? ?1(?: 0)?", "gpl 1 0(?: only| or later)?"),
    ("gpl-2", "gnu general public licen", r"gnu general public licen[cs]e(?: version| v)? ?2(?: 0)?", "gpl 2 0(?: only| or later)?"),
    ("gpl-3", "gnu general public licen", r"gnu general public licen[cs]e(?: version| v)? ?3(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("gpl-2", "gpl", r"gpl ?(?:version |v)?2(?: 0)?", ""),
    ("gpl-3", "gpl", r"gpl ?(?:version |v)?3(?: 0)?", ""),
    ("gpl", "gnu", r"gnu general public licen[cs]e|gnu gpl", ""),
    ("lgpl-2", "gnu library general public licen", r"gnu library general public licen[cs]e(?: version| v)? ?2(?: 0)?", "lgpl 2 0(?: only| or later)?"),
    ("lgpl-2.1", "gnu lesser general public licen", r"gnu lesser general public licen[cs]e(?: version| v)? ?2 1", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-3", "gnu lesser general public licen", r"gnu lesser general public licen[cs]e(?: version| v)? ?3(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    ("lgpl", "gnu", r"gnu (?:lesser|library) general public licen[cs]e|gnu lgpl", ""),
    ("lgpl", "lgpl", r"lgpl(?: ?v?(?:2|2 1|3))?", ""),
    ("agpl-1", "affero general public licen", r"affero general public licen[cs]e(?: version)? 1(?: 0)?", "agpl 1 0(?: only| or later)?"),
    ("agpl-3", "affero general public licen", r"(?:gnu )?affero general public licen[cs]e(?: version| v)? ?3(?: 0)?", "agpl 3 0(?: only| or later)?"),
    ("agpl", "affero general public licen", r"(?:gnu )?affero general public licen[cs]e", ""),
    ("gfdl", "gnu free documentation licen", r"gnu free documentation licen[cs]e(?: version)?(?: 1 [123])?", "gfdl 1 [123](?: only| or later)?"),
    ("mpl-1", "mozilla public licen", r"mozilla public licen[cs]e(?: version)? 1(?: [01])?", "mpl 1 [01]"),
    ("mpl-2", "mozilla public licen", r"mozilla public licen[cs]e(?: version| v)? ?2(?: 0)?", "mpl 2 0"),
    ("mpl", "mozilla public licen", r"mozilla public licen[cs]e", ""),
    ("epl-1", "eclipse public licen", r"eclipse public licen[cs]e(?: version| v)? ?1(?: 0)?", "epl 1 0"),
    ("epl-2", "eclipse public licen", r"eclipse public licen[cs]e(?: version| v)? ?2(?: 0)?", "epl 2 0"),
    ("edl-1", "eclipse distribution licen", r"eclipse distribution licen[cs]e(?: v ?1 0)?", ""),
    ("cddl-1", "common development and distribution licen", r"common development and distribution licen[cs]e(?: version)?(?: 1 [01])?", "cddl 1 [01]"),
    ("cpl-1", "common public licen", r"common public licen[cs]e(?: version)?(?: 1 0)?", "cpl 1 0"),
    ("cpal-1", "common public attribution licen", r"common public attribution licen[cs]e(?: version)?(?: 1 0)?", "cpal 1 0"),
    ("ipl-1", "ibm public licen", r"ibm public licen[cs]e(?: version)?(?: 1 0)?", "ipl 1 0"),
    ("artistic-1", "artistic licen", r"artistic licen[cs]e(?: version)? 1(?: 0)?", "artistic 1 0"),
    ("artistic-2", "artistic licen", r"artistic licen[cs]e(?: version)? 2(?: 0)?", "artistic 2 0"),
    ("artistic", "artistic licen", r"artistic licen[cs]e", ""),
    ("python-2", "python", r"python (?:software foundation )?licen[cs]e(?: version 2)?", "(?:python|psf) 2 0"),
    ("php-3", "php licen", r"php licen[cs]e(?: version)?(?: 3(?: 0?1)?)?", "php 3 0?1?"),
    ("ruby", "ruby licen", r"ruby licen[cs]e", "ruby"),
    ("openssl", "openssl licen", r"openssl licen[cs]e", "openssl"),
    ("postgresql", "postgresql licen", r"postgresql licen[cs]e", "postgresql"),
    ("ncsa", "ncsa", r"university of illinois ncsa open source licen[cs]e|ncsa licen[cs]e", "ncsa"),
    ("ecl-2", "educational community licen", r"educational community licen[cs]e(?: version)?(?: 2 0)?", "ecl 2 0"),
    ("afl-3", "academic free licen", r"academic free licen[cs]e(?: version| v)?(?: ?3 0)?", "afl 3 0"),
    ("osl-3", "open software licen", r"open software licen[cs]e(?: version| v)?(?: ?3 0)?", "osl 3 0"),
    ("eupl-1", "european union public licen", r"european union public licen[cs]e(?: version| v)?(?: ?1 [012])?", "eupl 1 [012]"),
    ("cecill-2", "cecill", r"cecill(?: [bc])?(?: free software)?(?: licen[cs]e)?(?: version)?(?: 2 [01])?", "cecill 2 [01]"),
    ("ms-pl", "microsoft public licen", r"microsoft public licen[cs]e", "ms pl"),
    ("ms-rl", "microsoft reciprocal licen", r"microsoft reciprocal licen[cs]e", "ms rl"),
    ("apsl-2", "apple public source licen", r"apple public source licen[cs]e(?: version)?(?: 2 0)?", "apsl 2 0"),
    ("bsl-1.1", "business source licen", r"business source licen[cs]e(?: version)?(?: 1 1)?", "busl 1 1"),
    ("sspl-1", "server side public licen", r"server side public licen[cs]e(?: version| v)?(?: ?1)?", "sspl 1 0"),
    ("elastic-2", "elastic licen", r"elastic licen[cs]e(?: version)?(?: 2 0)?", "elastic 2 0"),
    ("ofl-1.1", "sil open font licen", r"sil open font licen[cs]e(?: version)?(?: 1 [01])?", "ofl 1 1"),
    ("odbl-1", "database licen", r"open (?:data commons open )?database licen[cs]e(?: v1 0)?", "odbl 1 0"),
    ("odc-by-1", "commons attribution licen", r"open data commons attribution licen[cs]e(?: v1 0)?", "odc by 1 0"),
    ("pddl-1", "public domain dedication and licen", r"open data commons public domain dedication and licen[cs]e", "pddl 1 0"),
    ("cc0-1", "cc0", r"cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
    ("cc-by", "cc by", r"cc by(?: [1234](?: [05])?)?", "cc by [1234] [05]"),
    ("cc-by-sa", "cc by", r"cc by sa(?: [1234](?: [05])?)?", "cc by sa [1234] [05]"),
    ("cc-by-nd", "cc by", r"cc by nd(?: [1234](?: [05])?)?", "cc by nd [1234] [05]"),
    ("cc-by-nc", "cc by", r"cc by nc(?: [1234](?: [05])?)?", "cc by nc [1234] [05]"),
    ("cc-by-nc-sa", "cc by", r"cc by nc sa(?: [1234](?: [05])?)?", "cc by nc sa [1234] [05]"),
    ("cc-by-nc-nd", "cc by", r"cc by nc nd(?: [1234](?: [05])?)?", "cc by nc nd [1234] [05]"),
    ("cc-by", "creative commons attribution", r"creative commons attribution(?: [1234] 0)?(?: international| unported| generic)?(?: licen[cs]e)?", ""),
    ("cc-by-sa", "creative commons attribution", r"creative commons attribution share ?alike(?: [1234] 0)?(?: international| unported| generic)?(?: licen[cs]e)?", ""),
    ("cc-by-nd", "creative commons attribution", r"creative commons attribution no ?deriv(?:ative)?s(?: works)?(?: [1234] 0)?", ""),
    ("cc-by-nc", "creative commons attribution", r"creative commons attribution non ?commercial(?: [1234] 0)?(?: international| unported| generic)?(?: licen[cs]e)?", ""),
    ("cc-by-nc-sa", "creative commons attribution", r"creative commons attribution non ?commercial share ?alike(?: [1234] 0)?", ""),
    ("cc-by-nc-nd", "creative commons attribution", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1234] 0)?", ""),
    ("llama", "llama", r"llama (?:[234] )?community licen[cs]e(?: agreement)?", ""),
    ("openrail", "open rail", r"(?:bigscience |creativeml )?open rail(?: m| \+\+ m)?(?: licen[cs]e)?", ""),
    ("proprietary", "proprietary", r"proprietary(?: and confidential)?(?: software)? licen[cs]e|proprietary and confidential", ""),
    ("all-rights", "all rights reserved", r"all rights reserved", ""),
]

#: label, keyword, regex of whole sentences and addresses that stand for a license.
TEXTS = [
    ("mit", "permission is hereby granted free", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("isc", "permission to use copy modify", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution and use in source", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3", "endorse or promote products", r"may be used to endorse or promote products derived from this software"),
    ("bsd-4", "advertising materials mentioning", r"all advertising materials mentioning features or use of this software must display"),
    ("zlib", "altered source versions", r"altered source versions must be plainly marked as such"),
    ("unlicense", "unencumbered software released", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", "fuck you want to public licen", r"do what the fuck you want to public licen[cs]e"),
    ("gpl", "redistribute it and or modify it", r"you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
    ("lgpl", "redistribute it and or modify it", r"you can redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e"),
    ("agpl", "redistribute it and or modify it", r"you can redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e"),
    ("mpl-2", "source code form is subject", r"this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0"),
    ("boost-1", "boost software licen", r"distributed under the boost software licen[cs]e version 1 0"),
    ("ofl-1.1", "font software is licensed", r"this font software is licensed under the sil open font licen[cs]e version 1 1"),
    ("cc0-1", "waived all copyright", r"has waived all copyright and related or neighboring rights"),
    ("apache-2", "apache org licenses", r"https? (?:www )?apache org licenses licen[cs]e 2 0(?: txt| html)?"),
    ("mit", "opensource org licenses", r"https? (?:www )?opensource org licenses mit(?: licen[cs]e)?(?: php)?"),
    ("bsd-2", "opensource org licenses", r"https? (?:www )?opensource org licenses bsd 2 clause"),
    ("bsd-3", "opensource org licenses", r"https? (?:www )?opensource org licenses bsd 3 clause"),
    ("gpl", "gnu org", r"https? (?:www )?gnu org (?:licenses|copyleft) gpl(?: html| txt)?"),
    ("gpl-2", "gnu org", r"https? (?:www )?gnu org licenses (?:old licenses )?gpl 2 0"),
    ("gpl-3", "gnu org", r"https? (?:www )?gnu org licenses gpl 3 0"),
    ("lgpl", "gnu org", r"https? (?:www )?gnu org licenses lgpl"),
    ("agpl", "gnu org", r"https? (?:www )?gnu org licenses agpl"),
    ("mpl-2", "mozilla org", r"https? (?:www )?mozilla org (?:en us )?mpl 2 0"),
    ("epl-2", "eclipse org legal epl", r"https? (?:www )?eclipse org legal epl (?:2 0|v20)"),
    ("boost-1", "boost org licen", r"https? (?:www )?boost org licen[cs]e 1 0 txt"),
    ("wtfpl", "wtfpl net", r"https? (?:www )?wtfpl net"),
    ("unlicense", "unlicense org", r"https? (?:www )?unlicense org"),
    ("cc0-1", "creativecommons org", r"https? (?:www )?creativecommons org publicdomain zero 1 0"),
    ("cc-by", "creativecommons org", r"https? (?:www )?creativecommons org licenses by [1234] [05]"),
    ("cc-by-sa", "creativecommons org", r"https? (?:www )?creativecommons org licenses by sa [1234] [05]"),
    ("cc-by-nd", "creativecommons org", r"https? (?:www )?creativecommons org licenses by nd [1234] [05]"),
    ("cc-by-nc", "creativecommons org", r"https? (?:www )?creativecommons org licenses by nc [1234] [05]"),
    ("cc-by-nc-sa", "creativecommons org", r"https? (?:www )?creativecommons org licenses by nc sa [1234] [05]"),
    ("cc-by-nc-nd", "creativecommons org", r"https? (?:www )?creativecommons org licenses by nc nd [1234] [05]"),
]

_GRANT = r"(?:licensed|released|distributed|available|provided|published|redistributed|covered|made available|dual licensed|offered|issued) (?:to you )?(?:under|with|by|on) (?:the )?(?:terms (?:and conditions )?of )?(?:the |an? )?(?:open source )?"
#: Priorities, highest first: identifiers, whole texts and addresses, grants, bare names. Weights give the score.
PRIORITIES = 4
WEIGHTS = [1.0, 0.95, 0.9, 0.6]


def rules() -> list[tuple[int, str, str, str]]:
    """Priority, keyword, regex and label of every rule, in order."""
    out = []
    for label, keyword, name, spdx in NAMES:
        if spdx:
            out.append((0, "spdx", rf"spdx licen[cs]e identifier (?:{spdx})", label))
            out.append((0, "licen", rf"licen[cs]e (?:id |identifier )?(?:{spdx})", label))
    out += [(1, keyword, regex, label) for label, keyword, regex in TEXTS]
    for label, keyword, name, _ in NAMES:
        out.append((2, keyword, rf"{_GRANT}(?:{name})", label))
        out.append((3, keyword, name, label))
    return out


def normal_words(text: Column) -> Column:
    """The text's words, each with one space before and one after: ' w1 w2 '; ' ' without words."""
    spaced = F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS, " "))
    return F.when(spaced == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), spaced, F.lit(" ")))


def _spaces(text: Column) -> Column:
    return (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def scan(df: DataFrame, text: str, id_col: str = "doc_id") -> DataFrame:
    """One row per row of df: id_col, the base columns, labels, score and detections.

    detections is the ordered array of all spans (first_word, last_word, priority, label), before
    suppression; labels come from those that suppression leaves, and from the base phrases.
    """
    table = rules()
    words = df.select(F.col(id_col), normal_words(F.col(text)).alias("w"))
    words = words.withColumn("n_words", _spaces(F.col("w")) - 1)

    places, firsts, lasts, labels = [], [], [], []
    for phrase, label in BASE_PHRASES.items():
        found = F.contains(F.col("w"), F.lit(f" {phrase} "))
        parts = F.split("w", f"(?<= ){phrase}(?= )")
        places.append(F.when(found, F.size(parts) - 1).otherwise(0).cast("long"))
        firsts.append(F.when(found, _spaces(F.element_at(parts, 1)) - 1))
        lasts.append(F.when(found, F.col("n_words") - (_spaces(F.element_at(parts, -1)) - 1) - len(phrase.split())))
        labels.append(F.when(found, F.lit(label)))
    base = words.select(
        "*",
        sum(places[1:], places[0]).alias("n_base"),
        F.least(*firsts).alias("first_word"),
        F.greatest(*lasts).alias("last_word"),
        F.array_compact(F.array(*labels)).alias("base"),
    )

    keywords = sorted({k for _, k, _, _ in table})
    # by first letters, so that most words are done with after one look
    letters = "|".join(f"{c}(?:{'|'.join(k[1:] for k in keywords if k[0] == c)})" for c in sorted({k[0] for k in keywords}))
    gate = F.rlike(F.col("w"), F.lit(f" (?:{letters})"))
    literal = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(k).alias("k"), F.lit(f"(?<= )(?:{r})(?= )").alias("r"), F.lit(label).alias("label")) for p, k, r, label in table])
    held = F.filter(F.array(*map(F.lit, keywords)), lambda k: F.contains(F.col("w"), F.concat(F.lit(" "), k)))

    def spans(rule: Column) -> Column:
        # each match gets a mark before its first and after its last word
        marked = F.split(F.trim(F.regexp_replace(F.col("w"), rule["r"], F.lit("\x01$0\x02"))), " ")
        numbered = F.transform(marked, lambda x, i: F.struct(F.startswith(x, F.lit("\x01")).alias("a"), F.endswith(x, F.lit("\x02")).alias("z"), i.alias("i")))
        edges = F.filter(numbered, lambda x: x["a"] | x["z"])
        starts = F.transform(F.filter(edges, lambda x: x["a"]), lambda x: x["i"])
        ends = F.transform(F.filter(edges, lambda x: x["z"]), lambda x: x["i"])
        return F.zip_with(starts, ends, lambda a, z: F.struct(a.alias("first_word"), (-z).alias("minus_last"), rule["p"].alias("priority"), rule["label"].alias("label")))

    chosen = F.filter(literal, lambda r: F.array_contains(F.col("held"), r["k"]) & F.rlike(F.col("w"), r["r"]))
    seen = base.withColumn("held", F.when(gate, held).otherwise(F.array().cast("array<string>")))
    none = F.array().cast("array<struct<first_word:int,minus_last:int,priority:int,label:string>>")
    seen = seen.withColumn("ordered", F.when(F.size("held") > 0, F.array_sort(F.flatten(F.transform(chosen, spans)))).otherwise(none))

    # one pass over the ordered spans: reach[p] is the last word of any earlier span of priority <= p
    start = F.struct(F.array(*[F.lit(-1)] * PRIORITIES).alias("reach"), F.array().cast("array<string>").alias("labels"), F.lit(PRIORITIES).alias("best"))

    def step(state: Column, d: Column) -> Column:
        last = -d["minus_last"]
        inside = F.get(state["reach"], d["priority"]) >= last
        reach = F.transform(state["reach"], lambda m, p: F.when(p >= d["priority"], F.greatest(m, last)).otherwise(m))
        return F.struct(
            reach.alias("reach"),
            F.when(inside, state["labels"]).otherwise(F.array_union(state["labels"], F.array(d["label"]))).alias("labels"),
            F.when(inside, state["best"]).otherwise(F.least(state["best"], d["priority"])).alias("best"),
        )

    seen = seen.withColumn("kept", F.when(F.size("ordered") > 0, F.aggregate("ordered", start, step)))
    weight = F.element_at(F.array(*[F.lit(x) for x in [*WEIGHTS, 0.0]]), F.coalesce(F.col("kept.best"), F.lit(PRIORITIES)) + 1)
    return seen.select(
        id_col,
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce(F.col("kept.labels"), F.array().cast("array<string>")))), ",").alias("labels"),
        F.greatest(weight, F.when(F.col("n_base") > 0, F.lit(0.9)).otherwise(F.lit(0.0))).alias("score"),
        F.transform("ordered", lambda d: F.struct(d["first_word"].alias("first_word"), (-d["minus_last"]).alias("last_word"), d["priority"].alias("priority"), d["label"].alias("label"))).alias("detections"),
    )


def oracle() -> str:
    """scan()'s columns but detections, in DuckDB: rules tried at every word, and suppression pair by pair."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    table = ", ".join(f"({p}, {quoted(k)}, {quoted(r)}, {quoted(label)})" for p, k, r, label in rules())
    phrases = ", ".join(f"({quoted(p)}, {quoted(label)}, {len(p.split())})" for p, label in BASE_PHRASES.items())
    weights = " ".join(f"WHEN {p} THEN {x}" for p, x in enumerate(WEIGHTS))
    return rf"""
WITH rules(p, k, r, label) AS (VALUES {table}), phrases(phrase, label, size) AS (VALUES {phrases}),
d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_UPPER.lower()}'), '{SEPARATORS}'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT *, ' ' || array_to_string(ws, ' ') || ' ' AS w FROM d),
bp AS (SELECT doc_id, ws, phrase, label, size, unnest(range(1, len(ws) + 1)) AS i FROM w JOIN phrases ON contains(w, ' ' || phrase || ' ')),
b AS (SELECT doc_id, count(*) AS n_base, min(i) - 1 AS first_word, max(i) - 1 AS last_word, list(DISTINCT label) AS base FROM bp
  WHERE array_to_string(ws[i:i + size - 1], ' ') = phrase GROUP BY doc_id),
dr AS (SELECT doc_id, ws, p, r, label FROM w JOIN rules ON contains(w, ' ' || k) WHERE regexp_matches(w, ' (?:' || r || ') ')),
po AS (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM dr),
s AS (SELECT doc_id, i, p, label, regexp_extract(array_to_string(ws[i:i + 47], ' ') || ' ', '^((?:' || r || ')) ', 1) AS m FROM po),
h AS (SELECT doc_id, i AS a, i + len(string_split(m, ' ')) - 1 AS z, p, label FROM s WHERE m <> ''),
kept AS (SELECT doc_id, list(DISTINCT label) AS labels, min(p) AS best FROM h x WHERE NOT EXISTS (
  SELECT 1 FROM h o WHERE o.doc_id = x.doc_id AND o.a <= x.a AND o.z >= x.z
    AND (o.p < x.p OR (o.p = x.p AND ((o.a, o.z) <> (x.a, x.z) OR o.label < x.label)))) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(labels, [])))), ',') AS labels,
  greatest(CASE best {weights} ELSE 0.0 END, CASE WHEN n_base > 0 THEN 0.9 ELSE 0.0 END)::DOUBLE AS score
FROM w LEFT JOIN b USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
