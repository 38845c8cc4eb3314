"""License texts inside documents: MinHash bands over overlapping text windows.

Templates and documents become hashed shingles of three words for the search. Templates are
partitioned by size, and each partition has windows of twice its size (see ``windows``).
One band is one of 64 MinHash values: a window that shares a band with a template of its
partition is a candidate. A template that a window holds up to the threshold has at least a
fifth of the window's shingles, so a band collides with a chance of 1 - 0.8^64, about
1 - 6e-7. The templates are a fixed list, so their shingles and bands are constants of the
plan. A window can only collide if it holds a shingle of a template, so documents without
one are left out before any signature is made.

Candidates are verified exactly: the share of the template's distinct shingles of five
words that the document holds must be ``THRESHOLD`` or more. Templates have five words at
least. Null and empty texts hold no license. Repeated documents give repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm.columns import prepared, with_shingles
from gristmill.llm.decontaminate import partition_of
from gristmill.llm.windows import (
    KEYS,
    candidate_texts,
    dealt_texts,
    set_signatures,
    signature_values,
    window_signatures,
)

SEARCH_WIDTH, WIDTH, THRESHOLD, BASE = 3, 5, 0.8, 8

# License notices as their licenses word them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing,"
        " software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR"
        " CONDITIONS OF ANY KIND, either express or implied."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the \"Software\"), to deal in the Software without restriction,"
        " including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,"
        " and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,"
        " subject to the following conditions: The above copyright notice and this permission notice shall be"
        " included in all copies or substantial portions of the Software."
    ),
    "MIT-notice": "This project is licensed under the MIT License.",
    "LGPL-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation"
    ),
    "AGPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero"
        " General Public License as published by the Free Software Foundation"
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights"
        " to this work"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation"
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met"
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License"
    ),
    "CC-BY-NC-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"
    ),
}


def shingled(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """``license``, its ``search`` shingles and its ``held`` shingles, both distinct."""
    rows = spark.createDataFrame(list(templates.items()), "license string, body string")
    wide = with_shingles(rows.withColumn("again", F.col("body")), "body", SEARCH_WIDTH, "search")
    both = with_shingles(wide, "again", WIDTH, "held")
    return both.select("license", F.array_distinct("search").alias("search"), F.array_distinct("held").alias("held"))


def _may_hold(docs: DataFrame, text: str, texts: DataFrame) -> DataFrame:
    """The documents that share a search shingle with a template. Sets without a common shingle
    have no common minimum, so no window of the others could collide: nothing is lost, and only
    these documents are shuffled and signed."""
    known = [row[0] for row in texts.select(F.explode("search")).distinct().collect()]
    spoken = with_shingles(docs.withColumn("_again", F.col(text)), "_again", SEARCH_WIDTH, "_search")
    # A plain filter would be pushed below the column of shingles, and into its loop.
    hit = F.when(F.exists("_search", lambda h: h.isin(known)), F.array(F.lit(1)))
    return spoken.select("*", F.explode_outer(hit).alias("_hit")).where("_hit is not null").drop("_search", "_hit")


def find_licenses(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    threshold: float = THRESHOLD,
    templates: dict[str, str] | None = None,
) -> DataFrame:
    """``key``, ``license``, ``containment`` for every document and template at the threshold. A
    template has five words or more."""
    texts = shingled(prepared(docs.sparkSession), TEMPLATES if templates is None else templates)
    placed = texts.withColumn("class", partition_of(F.size("search"), BASE))
    classes = sorted({row[0] for row in placed.select("class").distinct().collect()})
    narrow = docs.select(F.col(key).alias("_k"), F.col(text).cast("string").alias("_t"))
    dealt = dealt_texts(_may_hold(narrow, "_t", texts), "_t", "_k")
    # A band is the class and one value; the list of templates bounds the table.
    bands = signature_values(set_signatures(placed, ["license", "class"], "search"), ["license", "class"])
    windows = signature_values(window_signatures(dealt, SEARCH_WIDTH, BASE, classes), [*KEYS, "class"])
    candidates = windows.join(F.broadcast(bands), ["class", "value"]).select(*KEYS, "license")
    asked = candidate_texts(dealt, candidates, "license")
    spoken = with_shingles(asked, "_text", WIDTH, "has").select("_key", F.array_distinct("has").alias("has"), "_all")
    pairs = spoken.select("_key", "has", F.explode_outer("_all").alias("license"))
    both = pairs.join(F.broadcast(texts.select("license", "held")), "license")
    share = F.size(F.array_intersect("held", "has")) / F.size("held")
    return both.select(F.col("_key").alias(key), "license", share.alias("containment")).where(
        F.col("containment") >= threshold
    )
