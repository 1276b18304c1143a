"""License scan: ordered signature rules behind a keyword prefilter.

Texts become lower-case words parted by single spaces. Only texts with a
keyword are looked at; a rule's pattern runs only where letters stand that any
match of it has. Rules are sentences that stand in the licenses themselves, and names
of licenses in the forms they are met in. A hit that lies inside another goes, and so
does one that overlaps another of higher priority, before or after it; of two at
one place the surer stays. All of it is DataFrame functions; nothing leaves the row.
"""

from __future__ import annotations

from re import _constants, _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadbed.llm.common import texts

# Phrases that are always counted, and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Family keyword -> (label, pattern of the name, short identifier).
FAMILIES = {
    "mit": [("mit", "mit(?: x11| expat)?", "mit"), ("mit-0", "mit no attribution", "mit 0")],
    "apache": [
        ("apache-2", "apache(?: software)? (?:license )?(?:version |v )?2(?: 0)?", "apache 2 0"),
        ("apache-1.1", "apache(?: software)? (?:license )?(?:version |v )?1 1", "apache 1 1"),
        ("apache-1", "apache(?: software)? (?:license )?(?:version |v )?1 0", "apache 1 0"),
    ],
    "general public": [
        ("gpl-1", "gnu general public license(?: version| v)? 1", "gpl 1 0"),
        ("gpl-2", "gnu general public license(?: version| v)? 2", "gpl 2 0"),
        ("gpl-3", "gnu general public license(?: version| v)? 3", "gpl 3 0"),
        ("gpl", "gnu general public", "gpl"),
        ("agpl-3", "gnu affero general public license(?: version| v)? 3", "agpl 3 0"),
        ("agpl", "gnu affero general public", "agpl"),
        ("lgpl-2.1", "gnu lesser general public license(?: version| v)? 2 1", "lgpl 2 1"),
        ("lgpl-3", "gnu lesser general public license(?: version| v)? 3", "lgpl 3 0"),
        ("lgpl", "gnu (?:lesser|library) general public", "lgpl"),
    ],
    "gpl": [
        ("gpl-2", "gplv2|gpl(?: version| v)? 2", "gpl 2 0"),
        ("gpl-3", "gplv3|gpl(?: version| v)? 3", "gpl 3 0"),
        ("lgpl-2.1", "lgplv2(?: 1)?|lgpl(?: version| v)? 2 1", "lgpl 2 1"),
        ("lgpl-3", "lgplv3|lgpl(?: version| v)? 3", "lgpl 3 0"),
        ("agpl-3", "agplv3|agpl(?: version| v)? 3", "agpl 3 0"),
    ],
    "free documentation": [("gfdl", "gnu free documentation", "gfdl 1 3")],
    "bsd": [
        ("bsd-0", "(?:0|zero) clause bsd", "0bsd"),
        ("bsd-2", "(?:2|two) clause bsd|bsd (?:2|two) clause|simplified bsd|freebsd", "bsd 2 clause"),
        ("bsd-3", "(?:3|three) clause bsd|bsd (?:3|three) clause|(?:new|modified|revised) bsd", "bsd 3 clause"),
        ("bsd-4", "(?:4|four) clause bsd|bsd (?:4|four) clause|original bsd", "bsd 4 clause"),
        ("bsd", "bsd(?: style)?", "bsd"),
    ],
    "mozilla": [
        ("mpl-1.1", "mozilla public license(?: version| v)? 1 1", "mpl 1 1"),
        ("mpl-2", "mozilla public license(?: version| v)? 2(?: 0)?", "mpl 2 0"),
    ],
    "eclipse": [
        ("epl-1", "eclipse public license(?: version| v)? 1(?: 0)?", "epl 1 0"),
        ("epl-2", "eclipse public license(?: version| v)? 2(?: 0)?", "epl 2 0"),
        ("edl-1", "eclipse distribution", "edl 1 0"),
    ],
    "creative commons": [
        ("cc0", "creative commons (?:zero|cc0)", "cc0 1 0"),
        ("cc-by", "creative commons attribution", "cc by 4 0"),
        ("cc-by-sa", "creative commons attribution share ?alike", "cc by sa 4 0"),
        ("cc-by-nd", "creative commons attribution no ?deriv(?:ative)?s", "cc by nd 4 0"),
        ("cc-by-nc", "creative commons attribution non ?commercial", "cc by nc 4 0"),
        ("cc-by-nc-sa", "creative commons attribution non ?commercial share ?alike", "cc by nc sa 4 0"),
        ("cc-by-nc-nd", "creative commons attribution non ?commercial no ?deriv(?:ative)?s", "cc by nc nd 4 0"),
    ],
    "cc": [
        ("cc0", "cc0", "cc0 1 0"),
        ("cc-by", "cc by", "cc by 3 0"),
        ("cc-by-sa", "cc by sa", "cc by sa 3 0"),
        ("cc-by-nd", "cc by nd", "cc by nd 3 0"),
        ("cc-by-nc", "cc by nc", "cc by nc 3 0"),
        ("cc-by-nc-sa", "cc by nc sa", "cc by nc sa 3 0"),
        ("cc-by-nc-nd", "cc by nc nd", "cc by nc nd 3 0"),
    ],
    "boost": [("bsl-1", "boost software", "bsl 1 0")],
    "isc": [("isc", "isc", "isc")],
    "zlib": [("zlib", "zlib(?: libpng)?", "zlib")],
    "artistic": [("artistic-1", "artistic license 1(?: 0)?", "artistic 1 0"), ("artistic-2", "artistic license 2(?: 0)?", "artistic 2 0")],
    "european union": [("eupl-1.2", "european union public", "eupl 1 2")],
    "unlicense": [("unlicense", "unlicense", "unlicense")],
    "do what the": [("wtfpl", "do what the \\w+ you want to", "wtfpl")],
    "openssl": [("openssl", "openssl", "openssl")],
    "python software": [("psf-2", "python software foundation", "psf 2 0")],
    "php": [("php-3", "php license(?: version| v)? 3(?: 0\\d?)?", "php 3 01")],
    "open font": [("ofl-1.1", "(?:sil )?open font", "ofl 1 1")],
    "database": [("odbl-1", "open database", "odbl 1 0")],
    "common development": [("cddl-1", "common development and distribution", "cddl 1 0")],
    "microsoft": [("ms-pl", "microsoft public", "ms pl"), ("ms-rl", "microsoft reciprocal", "ms rl")],
    "postgresql": [("postgresql", "postgresql", "postgresql")],
    "server side": [("sspl-1", "server side public", "sspl 1 0")],
    "public domain": [("public-domain", "public domain", "public domain")],
    "rights reserved": [("proprietary", "all rights reserved", "proprietary")],
}

# Forms a name is met in, from surest to weakest, and their weight.
FORMS = [
    ("(?:licensed|released|distributed|published|available|provided|covered) under (?:the )?(?:terms of )?(?:the )?(?:{name})(?: public)?(?: licen[sc]e)?", 0.98),
    ("spdx license identifier {short}", 0.97),
    ("(?:under|subject to|in accordance with|governed by) (?:the )?(?:terms (?:and conditions )?of )?(?:the )?(?:{name})(?: public)?(?: licen[sc]e)?", 0.9),
    ("licen[sc]e (?:is )?(?:the )?(?:{name})(?: licen[sc]e)?", 0.8),
    ("(?:{name})(?: (?:software|public|open source|style))? licen[sc]ed?", 0.75),
]

# Words of a license itself -> (label, pattern of a sentence with them).
SIGNATURES = {
    "permission is hereby granted": [
        ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
        ("bsl-1", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software"),
        ("ofl-1.1", "permission is hereby granted free of charge to any person obtaining a copy of the font software"),
        ("unicode", "permission is hereby granted free of charge to any person obtaining a copy of (?:the unicode|data files and any associated)"),
        ("ncsa", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software"),
    ],
    "permission to use copy modify and": [
        ("isc", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted"),
        ("hpnd", "permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?without fee is hereby granted"),
        ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement"),
    ],
    "above copyright notice and this permission notice": [
        ("mit", "the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies or substantial portions of the software"),
        ("isc", "provided that the above copyright notice and this permission notice appear in all copies"),
    ],
    "redistribution and use in source and binary forms": [
        ("bsd", "redistribution and use in source and binary forms with or without modification are permitted(?: subject to the limitations in the disclaimer below)? provided that"),
        ("bsd-3-clear", "redistribution and use in source and binary forms with or without modification are permitted subject to the limitations in the disclaimer below"),
    ],
    "redistributions": [
        ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
        ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
    ],
    "the end user documentation included with the": [
        ("apache-1.1", "the end user documentation included with the redistributions? if any must include the following acknowledge?ment"),
    ],
    "be used to endorse or promote products derived from this software": [
        ("bsd-3", "neither the names? of (?:\\S+ ){1,12}(?:nor|and|or) (?:\\S+ ){1,8}may be used to endorse or promote products derived from this software"),
        ("bsd-3", "the names? of (?:the )?(?:author|contributors?|copyright holders?)s? may (?:not )?be used to endorse or promote products derived from this software"),
    ],
    "all advertising materials mentioning features": [
        ("bsd-4", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ],
    "you may not use this file except in compliance": [
        ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
        ("mpl-1.1", "the contents of this file are subject to the mozilla public license version 1 1 the license you may not use this file except in compliance"),
        ("cddl-1", "subject to the terms of the common development and distribution license (?:\\S+ ){0,12}you may not use this file except in compliance"),
        ("eupl-1.2", "licensed under the eupl (?:\\S+ ){0,24}you may not use this file except in compliance"),
    ],
    "terms and conditions for use reproduction and distribution": [
        ("apache-2", "apache license version 2 0 january 2004 (?:http \\S+ apache org licenses )?terms and conditions for use reproduction and distribution"),
    ],
    "each contributor hereby grants to you a perpetual worldwide": [
        ("apache-2", "subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable"),
    ],
    "you can redistribute it and or modify it under the terms of": [
        ("gpl-2", "free software you can redistribute it and or modify it under the terms of the gnu general public license (?:version 2 )?as published by the free software foundation(?: either)? version 2"),
        ("gpl-3", "free software you can redistribute it and or modify it under the terms of the gnu general public license (?:version 3 )?as published by the free software foundation(?: either)? version 3"),
        ("lgpl-2.1", "free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation(?: either)? version 2 1"),
        ("lgpl-3", "free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation(?: either)? version 3"),
        ("agpl-3", "free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation(?: either)? version 3"),
        ("wtfpl", "comes without any warranty (?:\\S+ ){0,8}you can redistribute it and or modify it under the terms of the do what"),
    ],
    "licenses for most software": [
        ("gpl-2", "the licenses for most software are designed to take away your freedom to share and change it by contrast the gnu general public license"),
    ],
    "free copyleft license for software": [
        ("gpl-3", "the gnu general public license is a free copyleft license for software and other kinds of works"),
        ("agpl-3", "the gnu affero general public license is a free copyleft license for software and other kinds of works"),
    ],
    "incorporates the terms and conditions of version 3": [
        ("lgpl-3", "this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license"),
    ],
    "specially designated software packages": [
        ("lgpl-2.1", "the lesser general public license applies to some specially designated software packages"),
    ],
    "copy distribute and or modify this document": [
        ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ],
    "source code form is subject to the terms": [
        ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ],
    "accompanying materials are made available under": [
        ("epl-1", "accompanying materials are made available under the terms of the eclipse public license (?:v|version )? ?1 0"),
        ("epl-2", "accompanying materials are made available under the terms of the eclipse public license (?:v|version )? ?2 0"),
    ],
    "the accompanying program is provided under": [
        ("epl-1", "the accompanying program is provided under the terms of this eclipse public license"),
        ("cpl-1", "the accompanying program is provided under the terms of this common public license"),
    ],
    "origin of this software must not be misrepresented": [
        ("zlib", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ],
    "altered source versions must be plainly marked": [
        ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ],
    "unencumbered software released into the public domain": [
        ("unlicense", "this is free and unencumbered software released into the public domain"),
    ],
    "anyone is free to copy modify publish": [
        ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary"),
    ],
    "waive all copyright and related": [
        ("cc0", "waive all copyright and related (?:or|and) neighboring rights"),
    ],
    "everyone is permitted to copy and distribute": [
        ("gnu-text", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
        ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed"),
    ],
    "you just do what the": [("wtfpl", "0 you just do what the \\S+ you want to")],
    "copying and distribution of this file with or without modification": [
        ("fsf-all-permissive", "copying and distribution of this file with or without modification are permitted in any medium without royalty"),
    ],
    "copyright holder maintains some semblance of artistic control": [
        ("artistic-1", "the copyright holder maintains some semblance of artistic control over the development of the package"),
    ],
    "retains some artistic control": [
        ("artistic-2", "the copyright holder retains some artistic control over the development of that package"),
    ],
    "this product includes software developed by": [
        ("openssl", "this product includes software developed by the openssl project for use in the openssl toolkit"),
        ("apache-1.1", "this product includes software developed by the apache software foundation"),
        ("bsd-4", "this product includes software developed by the university of california"),
    ],
    "python software foundation psf": [
        ("psf-2", "this license agreement is between the python software foundation psf and the individual or organization"),
    ],
    "this license governs use of the accompanying software": [
        ("ms-pl", "this license governs use of the accompanying software if you use the software you accept this license"),
    ],
    "reserved font name": [
        ("ofl-1.1", "no modified version of the font software may use the reserved font name"),
    ],
    "make the functionality of the program": [
        ("sspl-1", "if you make the functionality of the program or a modified version available to third parties as a service"),
    ],
    "share copy and redistribute the material in any medium": [
        ("cc-by", "share copy and redistribute the material in any medium or format"),
    ],
    "you may not use the material for commercial purposes": [
        ("cc-by-nc", "you may not use the material for commercial purposes"),
    ],
    "you must distribute your contributions under the same license": [
        ("cc-by-sa", "you must distribute your contributions under the same license as the original"),
    ],
    "you may not distribute the modified material": [
        ("cc-by-nd", "if you remix transform or build upon the material you may not distribute the modified material"),
    ],
    "as is without warranty of any kind": [
        ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ],
    "confidential": [
        ("proprietary", "unauthori[sz]ed copying of this file via any medium is strictly prohibited proprietary and confidential"),
        ("proprietary", "this software is (?:the )?confidential and proprietary information of"),
    ],
}

#: weight of a sentence of a license
_SIGNED = 0.99

#: names that speak for themselves need no word "license" beside them
_ALONE = {"creative commons", "cc", "general public", "gpl", "public domain", "rights reserved", "apache"}

_NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_LETTER = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"

#: a text without any of these has no license: each form has a word of the first
#: line, each name of ``_ALONE`` one of the second, each signature one of all
_GATE = (
    r"(?i)licen[sc]e|under|subject|accordance|governed"
    rf"|(?<!{_LETTER})cc0?(?!{_LETTER})|gpl|commons|rights|domain|apache|public"
    r"|software|permi(?:ssion|tted)|redistribut|artistic|functionality|commercial|confidential"
    r"|modified[\W_]+material|you[\W_]+just[\W_]+do"
)


def _needed(pattern: str) -> list[str]:
    """Of these, one stands in any text " … " that holds a match between spaces."""

    def longest(parsed) -> list[str]:
        items = list(parsed)
        if len(items) == 1 and items[0][0] is _constants.BRANCH:
            return [need for branch in items[0][1][1] for need in longest(branch)]
        found = [" "]
        for kind, value in items:
            if kind is _constants.LITERAL:
                found[-1] += chr(value)
            else:
                found.append("")
        found[-1] += " "
        return [max(found, key=len)]

    return longest(_parser.parse(pattern))


def rules() -> list[tuple[list[str], list[tuple[str, str, int, float]]]]:
    """(needed, [(pattern, label, priority, weight)]): sentences, and every name in every form."""
    out = [
        (_needed(keyword), [(f" (?:{pattern})(?= )", label, 0, _SIGNED) for label, pattern in own])
        for keyword, own in SIGNATURES.items()
    ]
    for keyword, names in FAMILIES.items():
        forms = FORMS + [("(?:{name})", 0.6)] * (keyword in _ALONE)
        for label, name, short in names:
            own = [
                (f" (?:{form.format(name=name, short=short)})(?= )", label, priority, weight)
                for priority, (form, weight) in enumerate(forms)
            ]
            by_name = ["{name}" in form for form, _ in forms]
            out.append((_needed(name), [rule for rule, named in zip(own, by_name) if named]))
            out += [
                (_needed(form.format(short=short)), [rule])
                for (form, _), rule, named in zip(forms, own, by_name)
                if not named
            ]
    return out


def _table() -> Column:
    def rule(pattern: str, label: str, priority: int, weight: float) -> Column:
        values = {"pattern": pattern, "label": label, "priority": priority, "weight": weight}
        return F.struct(*[F.lit(v).alias(k) for k, v in values.items()])

    return F.array(
        *[
            F.struct(F.array(*map(F.lit, needed)).alias("needed"), F.array(*[rule(*r) for r in own]).alias("rules"))
            for needed, own in rules()
        ]
    )


#: matches of a rule that are put in place by one fold, as a fold copies what it has
_CHUNK = 128


def _places(norm: Column, rule: Column) -> Column:
    """Hits of a rule: a match starts where the pieces and matches before it end.

    Matches are taken in chunks, each from where the chunks before it end.
    """
    gaps = F.transform(F.split(norm, rule.pattern, -1), F.length)
    sizes = F.transform(F.regexp_extract_all(norm, rule.pattern, F.lit(0)), F.length)
    steps = F.zip_with(gaps, sizes, lambda gap, size: F.struct(gap.alias("gap"), size.alias("size")))
    steps = F.filter(steps, lambda x: x["size"].isNotNull())

    def length(x: Column) -> Column:
        return x["gap"] + x["size"]

    def step(done: Column, x: Column) -> Column:
        start = done["at"] + x["gap"]
        hit = F.struct(
            start.alias("start"), (-x["size"]).alias("neg_size"), rule.priority.alias("priority"),
            rule.label.alias("label"), rule.weight.alias("weight"),
        )
        return F.struct((start + x["size"]).alias("at"), F.concat(done["hits"], F.array(hit)).alias("hits"))

    def placed(chunk: Column) -> Column:
        zero = F.struct(chunk["at"].alias("at"), F.expr(_NO_HITS).alias("hits"))
        return F.aggregate(chunk["steps"], zero, step, lambda done: done["hits"])

    def in_chunks(steps: Column) -> Column:
        last = F.floor((F.size(steps) - 1) / _CHUNK).cast("int")
        chunks = F.transform(
            F.sequence(F.lit(0), last),
            lambda k: F.slice(steps, k * _CHUNK + 1, F.lit(_CHUNK)),
        )
        return F.transform(
            chunks, lambda own: F.struct(own.alias("steps"), F.aggregate(own, F.lit(0), lambda n, x: n + length(x)).alias("n"))
        )

    def started(chunks: Column) -> Column:
        return F.transform(
            chunks,
            lambda own, k: F.struct(
                F.aggregate(F.slice(chunks, F.lit(1), k), F.lit(0), lambda n, before: n + before["n"]).alias("at"),
                own["steps"].alias("steps"),
            ),
        )

    # a list of one, so that what is worked out once has a name
    named = F.transform(F.array(steps), in_chunks)
    return F.flatten(F.flatten(F.transform(named, lambda chunks: F.transform(started(chunks), placed))))


_NO_HITS = "cast(array() as array<struct<start:int,neg_size:int,priority:int,label:string,weight:double>>)"
_NONE_OPEN = "cast(array() as array<struct<end:int,priority:int,label:string,weight:double,gone:boolean>>)"


def _resolved(hits: Column) -> Column:
    """(labels, doubt) of the hits that stay; doubt is what all of them leave.

    A hit is open until one starts behind its end: until then a surer one can
    still meet it. Matches have bounded length, so few are open at once.
    """

    def settled(kept: Column, ended: Column) -> Column:
        stay = F.filter(ended, lambda hit: ~hit["gone"])
        return F.struct(
            F.array_union(kept["labels"], F.transform(stay, lambda hit: hit["label"])).alias("labels"),
            F.aggregate(stay, kept["doubt"], lambda doubt, hit: doubt * (1 - hit["weight"])).alias("doubt"),
        )

    def step(kept: Column, hit: Column) -> Column:
        end = hit["start"] - hit["neg_size"]
        done = settled(kept["done"], F.filter(kept["open"], lambda x: x["end"] <= hit["start"]))
        still = F.filter(kept["open"], lambda x: x["end"] > hit["start"])
        met = F.transform(
            still,
            lambda x: F.struct(
                x["end"].alias("end"), x["priority"].alias("priority"), x["label"].alias("label"), x["weight"].alias("weight"),
                (x["gone"] | (x["priority"] > hit["priority"])).alias("gone"),
            ),
        )
        new = F.struct(
            end.alias("end"), hit["priority"].alias("priority"), hit["label"].alias("label"), hit["weight"].alias("weight"),
            F.exists(still, lambda x: x["priority"] < hit["priority"]).alias("gone"),
        )
        after = F.struct(
            end.alias("last"), done.alias("done"), F.concat(met, F.array(new)).alias("open")
        )
        return F.when(end <= kept["last"], kept).otherwise(after)

    nothing = F.struct(F.expr("cast(array() as array<string>)").alias("labels"), F.lit(1.0).cast("double").alias("doubt"))
    zero = F.struct(F.lit(-1).alias("last"), nothing.alias("done"), F.expr(_NONE_OPEN).alias("open"))
    return F.aggregate(F.array_sort(hits), zero, step, lambda kept: settled(kept["done"], kept["open"]))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Words, base phrases and license labels of every text.

    NULL and empty texts have no words, no labels and score 0. Repeated rows and
    rows without an id are scanned like others; an empty table gives no rows.
    """
    norm = F.trim(F.regexp_replace(F.translate("text", _UPPER, _LOWER), _NON_WORD, " "))
    words = texts(docs).select(
        "doc_id",
        F.regexp_count("text", F.lit(_WORD)).cast("bigint").alias("n_words"),
        F.when(F.col("text").rlike(_GATE), F.concat(F.lit(" "), norm, F.lit(" "))).alias("norm"),
    )

    def spaces(part: Column) -> Column:
        return (F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))).cast("bigint")

    found, firsts, lasts = [], [], []
    for phrase in BASE:
        n = F.coalesce(F.regexp_count("norm", F.lit(f" {phrase}(?= )")), F.lit(0)).cast("bigint")
        found.append(n)
        before = F.substring_index("norm", f" {phrase} ", 1)
        after = F.substring_index("norm", f" {phrase} ", -1)
        firsts.append(F.when(n > 0, spaces(before)))
        lasts.append(F.when(n > 0, F.col("n_words") - spaces(after) - len(phrase.split())))
    base = F.array_compact(F.array(*[F.when(n > 0, F.lit(label)) for n, label in zip(found, BASE.values())]))

    norm = F.col("norm")
    in_play = F.flatten(
        F.transform(
            F.filter(_table(), lambda f: F.exists(f.needed, lambda need: F.contains(norm, need))), lambda f: f.rules
        )
    )
    matching = F.filter(in_play, lambda rule: F.regexp_like(norm, rule.pattern))
    hits = F.flatten(F.transform(matching, lambda rule: _places(norm, rule)))
    based = words.select(
        "doc_id", "n_words", "norm",
        sum(found[1:], found[0]).alias("n_base"),
        F.least(*firsts).alias("first_word"), F.greatest(*lasts).alias("last_word"),
        F.array_sort(F.array_distinct(base)).alias("base"),
    )
    ruled = based.withColumn("kept", F.when(norm.isNotNull(), _resolved(hits)))
    labels = F.array_sort(F.array_union("base", F.coalesce("kept.labels", F.expr("cast(array() as array<string>)"))))
    doubt = F.coalesce("kept.doubt", F.lit(1.0))
    return ruled.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(1 - doubt).alias("score"),
    )
