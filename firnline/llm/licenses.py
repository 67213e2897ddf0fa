"""Licence scan by sentence rules.

Sentences are normalised and mapped to identifiers of known licence sentences;
a licence is recognised where its rule's identifiers occur in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known licence sentences (normalised when used) by identifier.  A
# sentence ends where the scan ends it, so one with "v. 2.0" stops at the "v".
SENTENCES: dict[str, str] = {
    "mit_released": "Released under the MIT License",
    "mit_licensed": "Licensed under the MIT License",
    "mit_title": "The MIT License",
    "mit_short_title": "MIT License",
    "mit_grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "mit_notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit_warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "apache_licensed": "Licensed under the Apache License, Version 2.0",
    "apache_header": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache_comply": "you may not use this file except in compliance with the License",
    "apache_obtain": "You may obtain a copy of the License at",
    "apache_unless": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "gpl3_work": "This work is licensed under the GNU General Public License, version 3",
    "gpl2_work": "This work is licensed under the GNU General Public License, version 2",
    "gpl_free": "This program is free software",
    "gpl3_terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl2_terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version",
    "gpl_hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "bsd_grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd_source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd_binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd_names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc_grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "cc_by": "Licensed under CC BY 4.0",
    "cc_by_sa": "Licensed under CC BY-SA 4.0",
    "cc_by_nc": "Licensed under CC BY-NC 4.0",
    "cc_by_work": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc_zero": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    "reserved": "All rights reserved",
}

# Licence and the sentences that must follow one another, in this order.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("Apache-2.0", ("apache_licensed",)),
    ("Apache-2.0", ("apache_header", "apache_comply", "apache_obtain")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_names")),
    ("CC-BY-4.0", ("cc_by",)),
    ("CC-BY-4.0", ("cc_by_work",)),
    ("CC-BY-NC-4.0", ("cc_by_nc",)),
    ("CC-BY-SA-4.0", ("cc_by_sa",)),
    ("CC0-1.0", ("cc_zero",)),
    ("GPL-2.0", ("gpl2_work",)),
    ("GPL-2.0-or-later", ("gpl_free", "gpl2_terms")),
    ("GPL-3.0", ("gpl3_work",)),
    ("GPL-3.0-or-later", ("gpl_free", "gpl3_terms")),
    ("ISC", ("isc_grant",)),
    ("MIT", ("mit_released",)),
    ("MIT", ("mit_licensed",)),
    ("MIT", ("mit_grant", "mit_notice")),
    ("MPL-2.0", ("mpl",)),
    ("Proprietary", ("reserved",)),
    ("Unlicense", ("unlicense",)),
]

#: A text without any of these words holds no known sentence.
HINT = r"(?i)licen[sc]|permi(t|ss)|redistribut|copyright|rights|public domain|warrant|free software|Creative Commons"
#: Sentences end at punctuation before white space; lines end too, or lines flow on.
BY_LINE, FLOWING = r"[.!?;:]+[\x20\x09-\x0D]+|[\x0A\x0D]+", r"[.!?;:]+[\x20\x09-\x0D]+|\x0A[\x20\x09\x0D]*\x0A"


def normal(sentence: str) -> str:
    """ASCII letters and digits, lower case, single spaces."""
    out = "".join(c if c.isascii() and c.isalnum() else " " for c in sentence)
    return " ".join(out.lower().split())


def normal_column(sentence: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(sentence, "[^A-Za-z0-9]+", " ")))


def identifiers(text: Column, ends: str) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    names = list(SENTENCES)
    known = F.array(*[F.lit(normal(SENTENCES[n])) for n in names])
    at = F.transform(F.split(text, ends, -1), lambda s: F.array_position(known, normal_column(s)))
    return F.transform(F.filter(at, lambda k: k > 0), lambda k: F.element_at(F.array(*[F.lit(n) for n in names]), k.cast("int")))


def in_order(ids: Column, rule: tuple[str, ...]) -> Column:
    """Whether the rule's identifiers occur in this order (others may lie between)."""
    steps = F.array(*[F.lit(r) for r in rule])
    reached = F.aggregate(ids, F.lit(0), lambda k, x: k + F.coalesce(F.get(steps, k) == x, F.lit(False)).cast("int"))
    return reached == len(rule)


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_sentences`` (known sentences, the larger
    count of both readings), ``sequence`` (their identifiers, line reading) and
    ``licenses`` (recognised licences, sorted), lists joined by commas.

    A text is read twice, with sentences ending at line ends and with sentences
    flowing over them; a rule may match either.  Null and empty texts hold nothing;
    ids may be null or repeated, each row is answered; an empty table gives no rows;
    other columns are not read.
    """
    t = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<string>")
    hint = t.rlike(HINT)
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).select(
        "doc_id",
        F.when(hint, identifiers(t, BY_LINE)).otherwise(none).alias("lines"),
        F.when(hint, identifiers(t, FLOWING)).otherwise(none).alias("flow"),
    )
    found = F.array_compact(F.array(*[
        F.when(in_order(F.col("lines"), rule) | in_order(F.col("flow"), rule), F.lit(name)) for name, rule in RULES
    ]))
    any_known = (F.size("lines") > 0) | (F.size("flow") > 0)
    return read.select(
        "doc_id", F.greatest(F.size("lines"), F.size("flow")).cast("long").alias("n_sentences"),
        F.array_join("lines", ",").alias("sequence"),
        F.when(any_known, F.array_join(F.array_distinct(found), ",")).otherwise("").alias("licenses"),
    )
