"""Licence recognition by sentence rules, in DataFrame functions only.

Comment marks are cut off and wrapped lines joined; a text is cut into sentences
at sentence ends, blank lines and lines that end one; each is normalised and mapped to the identifier
of a known licence sentence; the sequence of identifiers is then matched with
ordered licence rules. A rule is a run of identifiers (sentences without an
identifier in between don't break it, but a sentence that only looks like
licence text does: it counts as ``?``). Rules are tried in order, each takes
the runs it matches out of the sequence, so the full text of a licence is not
reported a second time by the rule of one of its sentences.

Only sentences with an anchor word can be known ones (``ANCHORS`` covers every
pattern), so other sentences cost one substring search.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import prepare

# Fixed values. Normalised sentence (lower case; runs of other characters than
# letters, digits, dot, plus and minus are one blank; no dot at the end) ->
# identifier; the first pattern that matches the whole sentence counts.
SENTENCES = (
    ("spdx-mit", r"(.* )?spdx-license-identifier mit"),
    ("spdx-apache-2.0", r"(.* )?spdx-license-identifier apache-2.0"),
    ("spdx-bsd-3", r"(.* )?spdx-license-identifier bsd-3-clause"),
    ("spdx-bsd-2", r"(.* )?spdx-license-identifier bsd-2-clause"),
    ("spdx-gpl-2", r"(.* )?spdx-license-identifier gpl-2.0(-only|-or-later|\+)?"),
    ("spdx-gpl-3", r"(.* )?spdx-license-identifier gpl-3.0(-only|-or-later|\+)?"),
    ("spdx-mpl-2", r"(.* )?spdx-license-identifier mpl-2.0"),
    ("spdx-lgpl", r"(.* )?spdx-license-identifier lgpl-[0-9.]+(-only|-or-later|\+)?"),
    ("spdx-agpl", r"(.* )?spdx-license-identifier agpl-3.0(-only|-or-later|\+)?"),
    ("spdx-isc", r"(.* )?spdx-license-identifier isc"),
    ("spdx-zlib", r"(.* )?spdx-license-identifier zlib"),
    ("spdx-boost", r"(.* )?spdx-license-identifier bsl-1.0"),
    ("spdx-epl-2", r"(.* )?spdx-license-identifier epl-2.0"),
    ("spdx-unlicense", r"(.* )?spdx-license-identifier unlicense"),
    ("spdx-cc0", r"(.* )?spdx-license-identifier cc0-1.0"),
    ("mit-named", r"(.* )?(released|licensed|distributed|available|provided) under (the )?(terms of )?(the )?mit licen[sc]e( .*)?"),
    ("mit-title", r"(the )?mit license( mit)?"),
    ("mit-grant", r"(.* )?permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files .*"),
    ("mit-notice", r"(.* )?the above copyright notice and this permission notice .*shall be included in all copies or substantial portions of the software"),
    ("as-is", r"(.* )?the software is provided as is without warranty of any kind .*"),
    ("isc-grant", r"(.* )?permission to use copy modify and( or)? distribute this software for any purpose with or without fee is hereby granted .*"),
    ("isc-as-is", r"the software is provided as is and the author disclaims all warranties .*"),
    ("boost-grant", r"(.* )?permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation .*"),
    ("boost-named", r"(.* )?distributed under the boost software license version 1.0.*"),
    ("zlib-as-is", r"(.* )?this software is provided as-is without any express or implied warranty"),
    ("zlib-grant", r"permission is granted to anyone to use this software for any purpose .*"),
    ("unlicense-grant", r"(.* )?this is free and unencumbered software released into the public domain"),
    ("epl-2-named", r"(.* )?(under the terms of|licensed under) the eclipse public license (v(ersion)? ?)?2.0.*"),
    ("bsd-grant", r"(.* )?redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met.*"),
    ("bsd-source", r"([0-9] )?redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-binary", r"([0-9] )?redistributions in binary form must reproduce the above copyright notice .*"),
    ("bsd-endorse", r"([0-9] )?neither the name of .* may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-as-is", r"this software is provided by the .* as is and any express or implied warranties .*"),
    ("apache-2.0-named", r"(.* )?(licensed|released|distributed|available) under (the )?(terms of )?(the )?apache license(,)? version 2.0( .*)?"),
    ("apache-comply", r"you may not use this file except in compliance with the license"),
    ("apache-copy", r"you may obtain a copy of the license at.*"),
    ("apache-as-is", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis .*"),
    ("gpl-3-named", r"(.* )?(licensed|released|distributed|available) under (the )?(terms of )?(the )?gnu general public license( as published by the free software foundation)?( either)? version 3.*"),
    ("gpl-2-named", r"(.* )?(licensed|released|distributed|available) under (the )?(terms of )?(the )?gnu general public license( as published by the free software foundation)?( either)? version 2.*"),
    ("agpl-grant", r"(.* )?free software you can redistribute it and or modify it under the terms of the gnu affero general public license .*"),
    ("lgpl-grant", r"(.* )?free software you can redistribute it and or modify it under the terms of the gnu (lesser|library) general public license .*"),
    ("agpl-named", r"(.* )?(licensed|released|distributed|available) under (the )?(terms of )?(the )?gnu affero general public license.*"),
    ("gpl-grant-3", r"(.* )?free software you can redistribute it and or modify it under the terms of the gnu general public license .*version 3.*"),
    ("gpl-grant-2", r"(.* )?free software you can redistribute it and or modify it under the terms of the gnu general public license .*version 2.*"),
    ("gpl-hope", r"(.* )?distributed in the hope that it will be useful but without any warranty.*"),
    ("gpl-copy", r"you should have received a copy of the gnu (lesser |library |affero )?general public license .*"),
    ("lgpl-named", r"(.* )?(licensed|released|distributed|available) under (the )?(terms of )?(the )?gnu (lesser|library) general public license.*"),
    ("mpl-2-named", r"(.* )?(subject to|licensed under|released under) the terms of the mozilla public license v(ersion)?\.? ?2.0.*"),
    ("cc-by-nc-sa", r"(.* )?(licensed|released|distributed|available) under (a |the )?(cc|creative commons) by-nc-sa [0-9.]+.*"),
    ("cc-by-nc-nd", r"(.* )?(licensed|released|distributed|available) under (a |the )?(cc|creative commons) by-nc-nd [0-9.]+.*"),
    ("cc-by-nc", r"(.* )?(licensed|released|distributed|available) under (a |the )?(cc|creative commons) by-nc [0-9.]+.*"),
    ("cc-by-sa", r"(.* )?(licensed|released|distributed|available) under (a |the )?(cc|creative commons) by-sa [0-9.]+.*"),
    ("cc-by", r"(.* )?(licensed|released|distributed|available) under (a |the )?(cc|creative commons) by [0-9.]+.*"),
    ("cc0", r"(.* )?(licensed|released|dedicated|available) .*(cc0|public domain).*"),
    ("all-rights", r"(.* )?all rights reserved"),
    ("copyright", r"(.* )?copyright( c)? [0-9]{4}.*"),
)
# Licence, run of sentence identifiers; tried in this order.
RULES = (
    ("MIT", ("mit-title", "copyright", "mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("ISC", ("isc-grant", "isc-as-is")),
    ("ISC", ("isc-grant", "as-is")),
    ("Zlib", ("zlib-as-is", "zlib-grant")),
    ("AGPL-3.0", ("agpl-grant", "gpl-hope", "gpl-copy")),
    ("LGPL", ("lgpl-grant", "gpl-hope", "gpl-copy")),
    ("AGPL-3.0", ("agpl-grant",)),
    ("LGPL", ("lgpl-grant",)),
    ("BSL-1.0", ("boost-grant", "as-is")),
    ("BSL-1.0", ("boost-grant",)),
    ("BSL-1.0", ("boost-named",)),
    ("Unlicense", ("unlicense-grant",)),
    ("EPL-2.0", ("epl-2-named",)),
    ("AGPL-3.0", ("agpl-named",)),
    ("LGPL", ("spdx-lgpl",)),
    ("AGPL-3.0", ("spdx-agpl",)),
    ("ISC", ("spdx-isc",)),
    ("Zlib", ("spdx-zlib",)),
    ("BSL-1.0", ("spdx-boost",)),
    ("EPL-2.0", ("spdx-epl-2",)),
    ("Unlicense", ("spdx-unlicense",)),
    ("CC0-1.0", ("spdx-cc0",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache-2.0-named", "apache-comply", "apache-copy", "apache-as-is")),
    ("Apache-2.0", ("apache-2.0-named", "apache-comply", "apache-copy")),
    ("Apache-2.0", ("apache-2.0-named", "apache-comply")),
    ("GPL-3.0", ("gpl-grant-3", "gpl-hope", "gpl-copy")),
    ("GPL-2.0", ("gpl-grant-2", "gpl-hope", "gpl-copy")),
    ("GPL-3.0", ("gpl-grant-3",)),
    ("GPL-2.0", ("gpl-grant-2",)),
    ("MIT", ("spdx-mit",)),
    ("Apache-2.0", ("spdx-apache-2.0",)),
    ("BSD-3-Clause", ("spdx-bsd-3",)),
    ("BSD-2-Clause", ("spdx-bsd-2",)),
    ("GPL-2.0", ("spdx-gpl-2",)),
    ("GPL-3.0", ("spdx-gpl-3",)),
    ("MPL-2.0", ("spdx-mpl-2",)),
    ("MIT", ("mit-named",)),
    ("MIT", ("mit-title",)),
    ("ISC", ("isc-grant",)),
    ("Apache-2.0", ("apache-2.0-named",)),
    ("GPL-3.0", ("gpl-3-named",)),
    ("GPL-2.0", ("gpl-2-named",)),
    ("LGPL", ("lgpl-named",)),
    ("MPL-2.0", ("mpl-2-named",)),
    ("CC-BY-NC-SA", ("cc-by-nc-sa",)),
    ("CC-BY-NC-ND", ("cc-by-nc-nd",)),
    ("CC-BY-NC", ("cc-by-nc",)),
    ("CC-BY-SA", ("cc-by-sa",)),
    ("CC-BY", ("cc-by",)),
    ("CC0-1.0", ("cc0",)),
)
# Every pattern above needs one of these.
ANCHORS = ("licen", "copyright", "permission", "redistribut", "warrant", "all rights reserved", "public domain",
           "software", "cc0", "under")
# Fixed value: a sentence that no pattern knows but that talks about a licence.
LOOKS_LIKE = r"(.* )?(licen[sc]ed? under|license version|hereby granted|all copies|without warranty|redistributions? )( .*|$)"
BREAK = r"[\n\r]+|[.!?;]+[ \t]+"
UNKNOWN = "?"
# Comment marks at the start of a line; a line that goes on in the next one (no sentence end before the
# line end, and the next line is not blank); stops inside a known sentence.
MARKS = r"(^|\n)[ \t]*(?:/\*+|\*+/?|//+|#+|;+|--+|<!--|%+)[ \t]*"
TAG = r"(spdx-license-identifier:[ \t]*[a-z0-9.+\-]+)"  # ends a sentence of its own
WRAPPED = r"([^.!?:;\s])[ \t]*\r?\n[ \t]*([^\s])"
INSIDE = (("free software; you can", "free software you can"), ("foundation; either", "foundation either"), ("public license, v. ", "public license v"), ("public license - v ", "public license v"))


def unwrapped(text: Column) -> Column:
    """Lower-cased text without comment marks, wrapped lines joined."""
    text = F.regexp_replace(F.regexp_replace(F.lower(text), MARKS, "$1"), TAG, "$1; ")
    text = F.regexp_replace(text, WRAPPED, "$1 $2")
    for a, b in INSIDE:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def sentences(text: Column) -> Column:
    """Normalised sentences that hold an anchor word, in order."""
    parts = F.filter(F.split(unwrapped(text), BREAK, -1), lambda s: reduce(lambda a, b: a | b, (F.contains(s, F.lit(w)) for w in ANCHORS)))
    clean = lambda s: F.btrim(F.regexp_replace(F.regexp_replace(s, r"[^a-z0-9.+\-]+", " "), r"[.\-]+( |$)", "$1"), F.lit(" "))
    return F.transform(parts, clean)


def _identify(s: Column) -> Column:
    whole = lambda pattern: s.rlike(f"^(?:{pattern})$")
    out = F.when(whole(SENTENCES[0][1]), SENTENCES[0][0])
    for name, pattern in SENTENCES[1:]:
        out = out.when(whole(pattern), name)
    return out.when(s.rlike(f"^{LOOKS_LIKE}"), UNKNOWN)


def scan(docs: DataFrame, column: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``sequence`` (identifiers of the known
    sentences in order, comma-joined, ``?`` for unknown licence-like ones),
    ``licences`` (names by the rules that matched, in rule order, distinct,
    comma-joined), ``n_matches`` (matched runs) and ``n_unmatched``
    (identifiers that no rule took).

    Null and empty texts have an empty sequence; repeated rows each get a row;
    other columns are ignored; an empty table gives no rows. Of texts of any
    length every sentence is looked at.
    """
    prepare(docs.sparkSession)
    text = F.coalesce(F.col(column), F.lit(""))
    ids = F.array_compact(F.transform(sentences(text), _identify))
    df = docs.select("doc_id", ids.alias("ids"))
    # ",a,,b," so that runs can be cut out without merging their neighbours
    df = df.select("doc_id", F.array_join("ids", ",").alias("sequence"),
                   F.when(F.size("ids") > 0, F.concat(F.lit(","), F.array_join("ids", ",,"), F.lit(","))).otherwise("").alias("left"))
    # the rules are folded over the sequence
    rules = F.array(*(F.struct(F.lit(n).alias("name"), F.lit("," + ",,".join(r) + ",").alias("token")) for n, r in RULES))
    start = F.struct(F.col("left").alias("rest"), F.array().cast("array<string>").alias("names"), F.lit(0).alias("n"))

    def step(state: Column, rule: Column) -> Column:
        rest = F.replace(state["rest"], rule["token"], F.lit("|"))
        # every cut replaces the token by one character
        n = F.when(rest == state["rest"], 0).otherwise(
            ((F.length(state["rest"]) - F.length(rest)) / (F.length(rule["token"]) - 1)).cast("int"))
        return F.struct(rest.alias("rest"), F.when(n > 0, F.array_append(state["names"], rule["name"])).otherwise(state["names"]).alias("names"),
                        (state["n"] + n).alias("n"))
    df = df.withColumn("m", F.when(F.col("left") == "", start).otherwise(F.aggregate(rules, start, step)))
    rest = F.length(F.col("m.rest")) - F.length(F.replace(F.col("m.rest"), F.lit(","), F.lit("")))
    return df.select("doc_id", "sequence", F.array_join(F.array_distinct("m.names"), ",").alias("licences"),
                     F.col("m.n").cast("long").alias("n_matches"), (rest / 2).cast("long").alias("n_unmatched"))


def oracle() -> str:
    """The same scan in DuckDB SQL (regular expressions, then nested replacements)."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    anchors = " OR ".join(f"contains(s, {q(w)})" for w in ANCHORS)
    case = "\n".join(f"WHEN regexp_full_match(t, {q(p)}) THEN {q(n)}" for n, p in SENTENCES)
    steps, last = [], "joined"
    for k, (name, run) in enumerate(RULES):
        token = q("," + ",,".join(run) + ",")
        steps.append(f"r{k} AS (SELECT * EXCLUDE (rest), replace(rest, {token}, '|') AS rest, "
                     f"((length(rest) - length(replace(rest, {token}, '|'))) / {len(token) - 3})::BIGINT AS n{k} FROM {last})")
        last = f"r{k}"
    text = f"regexp_replace(regexp_replace(lower(coalesce(text, '')), {q(MARKS)}, '\\1', 'g'), {q(TAG)}, '\\1; ', 'g')"
    text = f"regexp_replace({text}, {q(WRAPPED)}, '\\1 \\2', 'g')"
    for a, b in INSIDE:
        text = f"replace({text}, {q(a)}, {q(b)})"
    names = ", ".join(f"CASE WHEN n{k} > 0 THEN {q(n)} END" for k, (n, _) in enumerate(RULES))
    total = " + ".join(f"n{k}" for k in range(len(RULES)))
    return f"""
WITH parts AS (
  SELECT doc_id, unnest(x) AS s, generate_subscripts(x, 1) AS i
  FROM (SELECT doc_id, regexp_split_to_array({text}, '{BREAK}') AS x FROM documents)),
clean AS (
  SELECT doc_id, i, trim(regexp_replace(regexp_replace(s, '[^a-z0-9.+\\-]+', ' ', 'g'), '[.\\-]+( |$)', '\\1', 'g')) AS t
  FROM parts WHERE {anchors}),
ids AS (
  SELECT doc_id, i, CASE {case} WHEN regexp_matches(t, {q('^' + LOOKS_LIKE)}) THEN '?' END AS id FROM clean),
seq AS (SELECT doc_id, list(id ORDER BY i) AS l FROM ids WHERE id IS NOT NULL GROUP BY doc_id),
joined AS (
  SELECT d.doc_id, coalesce(array_to_string(l, ','), '') AS sequence,
         CASE WHEN l IS NULL THEN '' ELSE ',' || array_to_string(l, ',,') || ',' END AS rest
  FROM documents d LEFT JOIN seq ON seq.doc_id = d.doc_id),
{", ".join(steps)},
named AS (SELECT *, list_filter([{names}], lambda x: x IS NOT NULL) AS a FROM {last})
SELECT doc_id, sequence,
       array_to_string(list_filter(a, lambda x, i: list_position(a, x) = i), ',') AS licences,
       ({total})::BIGINT AS n_matches,
       ((length(rest) - length(replace(rest, ',', ''))) / 2)::BIGINT AS n_unmatched
FROM named
"""
