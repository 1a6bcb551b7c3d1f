"""Licence scans by sentence-rule recognition (DataFrame functions only).

Every text is cut into sentences and these into lines; an equi-join of runs of lines
with the table of known licence sentences gives sentence identifiers. A licence rule is
an ordered sequence of identifiers; it is found where its sentences follow each other
directly in the text. A find that lies inside a longer find is dropped.

A sentence ends at a line without letters and digits, before a URL, or after ``.``,
``!``, ``?`` or ``:`` before white space (a full stop between digits, as in "2.0", ends
none). A single line end may or may not end one: a known sentence may begin at any line
and end at any line of its sentence, so hard-wrapped texts and unpunctuated lines both
match. List marks such as "1." and comment marks at line starts are no words.
Normalised: lower-cased, runs of characters other than a-z, 0-9 and code points above
127 become one space. Rules are cut by the same function as texts. Places in a text are
numbers of lines so cut.

Defined cases: null, empty and blank texts have no sentences and no licence;
repeated rows are scanned once each by id (rows that share an id share its finds);
a licence found twice counts twice in ``n_matches`` and once in ``licences``; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Licence rules as ordered sentences of the public licence notices.
LICENCE_RULES: dict[str, tuple[str, tuple[str, ...]]] = {
    "mit-short": ("MIT", ("Released under the MIT License.",)),
    "mit-notice": ("MIT", ("This project is licensed under the MIT License.",)),
    "mit-text": ("MIT", (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.")),
    "apache-2.0-short": ("Apache-2.0", ("Licensed under the Apache License, Version 2.0.",)),
    "apache-2.0-notice": ("Apache-2.0", (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at")),
    "gpl-3.0-short": ("GPL-3.0", ("This work is licensed under the GNU General Public License, version 3.",)),
    "gpl-3.0-notice": ("GPL-3.0-or-later", (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
        "See the GNU General Public License for more details.")),
    "agpl-3.0-notice": ("AGPL-3.0-or-later", (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
        "See the GNU Affero General Public License for more details.")),
    "gpl-2.0-notice": ("GPL-2.0-or-later", (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
        "See the GNU General Public License for more details.")),
    "mpl-2.0-notice": ("MPL-2.0", (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at")),
    "isc-text": ("ISC", (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",)),
    "unlicense-text": ("Unlicense", (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.")),
    "cc-by-nc-4.0-short": ("CC-BY-NC-4.0", ("Licensed under CC BY-NC 4.0.",)),
    "cc-by-nc-4.0-notice": ("CC-BY-NC-4.0", ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",)),
    "cc-by-4.0-notice": ("CC-BY-4.0", ("This work is licensed under a Creative Commons Attribution 4.0 International License.",)),
    "cc-by-sa-4.0-notice": ("CC-BY-SA-4.0", ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",)),
    "bsd-3-clause-text": ("BSD-3-Clause", (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.")),
    "bsd-2-clause-text": ("BSD-2-Clause", (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.")),
}

# every alternative starts at one place of a run of white space, so long runs cost no square
_END = r"\n[^\p{L}\p{N}\n]*+(?=\n)|(?<=[.!?:])\s++|(?<!\s)\s++(?=https?://)"
_MARK = r"^[^\p{L}\p{N}(]*+\(?(?:[0-9]{1,3}[.)]|[A-Za-z]\))\s++"       # of a list
_COMMENT = r"(?im)^[\x20\t]*+(?:rem|dnl)\b[\x20\t]*+"                     # others have no letters


def normalised(sentence: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(sentence), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def lines(text: Column) -> Column:
    """Normalised lines of a text in order, with ``left``: how many follow in the same sentence, itself included."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), _COMMENT, "")
    cut = F.filter(F.split(bare, _END), lambda s: s.rlike(r"\p{L}"))
    cut = F.transform(cut, lambda s: F.filter(
        F.transform(F.split(F.regexp_replace(s, r"^[^\p{L}]*+\n", ""), r"\n"),
                    lambda x: normalised(F.regexp_replace(x, _MARK, ""))), lambda x: x != ""))
    return F.flatten(F.transform(cut, lambda s: F.transform(
        s, lambda x, i: F.struct(x.alias("line"), (F.size(s) - i).alias("left")))))


def rule_tables(spark: SparkSession, rules=None) -> tuple[DataFrame, DataFrame]:
    """(sentence, sid) of the known sentences, and (rule, licence, size, step, sid) of the rules."""
    rules = LICENCE_RULES if rules is None else rules
    raw = spark.createDataFrame([(name, lic, "\n\n".join(" ".join(s.split()) for s in seq)) for name, (lic, seq) in sorted(rules.items())],
                                "rule string, licence string, text string")
    norm = (raw.select("rule", "licence", F.transform(lines(F.col("text")), lambda x: x["line"]).alias("s"))
            .select("rule", "licence", F.size("s").alias("size"), F.posexplode("s").alias("step", "sentence"))
            .withColumn("sid", F.xxhash64("sentence")))
    return norm.select("sentence", "sid").distinct(), norm.drop("sentence")


def cover_words(sentences_known: list[str]) -> list[str]:
    """A few words such that every known sentence holds one of them (greedy cover)."""
    left, chosen = [set(s.split()) for s in sentences_known if s.split()], []
    while left:
        words = sorted({w for s in left for w in s}, key=lambda w: (-sum(w in s for s in left) * (len(w) > 4), -len(w), w))
        chosen.append(words[0])
        left = [s for s in left if words[0] not in s]
    return chosen


def recognised(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, end, sid): the runs of lines of each text that are licence sentences.

    Only texts that hold a word of the cover are cut, which loses none: a licence
    sentence holds one of those words. A run begins where a known sentence's first word
    does and has no more lines than the longest known sentence has words. The known
    table is fixed and small, so it is broadcast.
    """
    told = [r[0] for r in known.select("sentence").collect()]
    text = F.lower(F.col("_text"))
    maybe = F.lit(False)
    for w in cover_words(told):
        maybe = maybe | text.contains(w)
    firsts = sorted({s.split(" ")[0] for s in told})
    longest = max((len(s.split(" ")) for s in told), default=0)

    def runs(u, i):
        many = F.sequence(F.lit(1), F.least(u["left"], F.lit(longest)))
        join = lambda n: F.array_join(F.transform(F.slice("_lines", i + 1, n), lambda x: x["line"]), " ")
        return F.when(F.substring_index(u["line"], " ", 1).isin(firsts), F.transform(
            many, lambda n: F.struct(i.alias("start"), (i + n).alias("end"), join(n).alias("sentence"))))

    parts = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")).where(maybe)
             .select("doc_id", lines(F.col("_text")).alias("_lines"))
             .select("doc_id", F.explode(F.filter(F.transform("_lines", runs), lambda r: r.isNotNull())).alias("_runs"))
             .select("doc_id", F.inline("_runs")))
    return parts.join(F.broadcast(known), "sentence").select("doc_id", "start", "end", "sid").distinct()


def matches(found: DataFrame, steps: DataFrame) -> DataFrame:
    """(doc_id, rule, licence, start, end, size): rules whose sentences follow each other directly."""
    at = found.join(F.broadcast(steps), "sid").drop("sid")
    per_rule = at.groupBy("doc_id", "rule", "licence", "size").agg(
        F.sort_array(F.collect_set(F.struct("start", "step", "end"))).alias("all"))
    # in the order of places: ``open`` maps (end, next step) of a begun run to its start
    begun = F.create_map().cast("map<string,int>")
    key = lambda end, step: F.concat_ws(":", end, step)
    one = "struct<start:int,end:int>"

    def walk(acc, m):
        first = F.when(m["step"] == 0, m["start"]).otherwise(acc["open"][key(m["start"], m["step"])])
        done = (m["step"] + 1 == F.col("size")) & first.isNotNull()
        following = key(m["end"], m["step"] + 1)
        add = first.isNotNull() & ~done & ~F.map_contains_key(acc["open"], following)
        return F.struct(
            F.when(add, F.map_concat(acc["open"], F.create_map(following, first))).otherwise(acc["open"]).alias("open"),
            F.when(done, F.array_append(acc["out"], F.struct(first.alias("start"), m["end"].alias("end")).cast(one)))
            .otherwise(acc["out"]).alias("out"))

    runs = per_rule.select("doc_id", "rule", "licence", "size", F.inline(F.aggregate(
        "all", F.struct(begun.alias("open"), F.array().cast(f"array<{one}>").alias("out")), walk, lambda a: a["out"])))
    per_doc = runs.groupBy("doc_id").agg(F.collect_list(F.struct("rule", "licence", "start", "end", "size")).alias("all"))
    best = F.filter("all", lambda m: ~F.exists("all", lambda o: (o["size"] > m["size"])
                    & (o["start"] <= m["start"]) & (o["end"] >= m["end"])))
    return per_doc.select("doc_id", F.explode(best).alias("m")).select("doc_id", "m.*")


def scan(docs: DataFrame, rules=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_matches, licences (sorted, distinct) and rules with their first sentence.

    Texts are matched row by row: rows that share an id are texts of their own, and a row
    without an id is matched like any other. Equal rows have equal finds.
    """
    known, steps = rule_tables(docs.sparkSession, rules)
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.struct(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")).alias("_key"), text.alias("_in"))
    finds = matches(recognised(keyed.select("_key", "_in"), known, "_key", "_in"), steps)
    per_text = finds.groupBy(F.col("doc_id").alias("_of")).agg(
        F.count(F.lit(1)).alias("n_matches"), F.sort_array(F.collect_set("licence")).alias("licences"),
        F.sort_array(F.collect_list(F.struct("start", "rule"))).alias("finds"))
    empty = F.array().cast("array<string>")
    return (keyed.select("doc_id", "_key").join(per_text, F.col("_key").eqNullSafe(F.col("_of")), "left")
            .select("doc_id", F.coalesce("n_matches", F.lit(0).cast("long")).alias("n_matches"),
                    F.coalesce("licences", empty).alias("licences"),
                    F.coalesce("finds", F.array().cast("array<struct<start:int,rule:string>>")).alias("finds")))
