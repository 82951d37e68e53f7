"""Licence scan by sentence rules.

A text is cut into sentences, each is normalised and looked up among known
licence sentences, and the sequence of their identifiers is matched against
ordered rules. A known sentence may also run on over line feeds, colons and
semicolons, as wrapped notices do. All of it is one expression over the text: nothing is exploded,
shuffled or sent to Python.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import texts

#: Known sentences, as normalised, and their identifiers.
SENTENCES = {
    "licensed under the apache license version 2 0": "apache_2_named",
    "licensed under the apache license version 2 0 the license": "apache_2_the_license",
    "you may not use this file except in compliance with the license": "apache_compliance",
    "you may obtain a copy of the license at": "apache_obtain",
    "spdx license identifier apache 2 0": "spdx_apache_2",
    "released under the mit license": "mit_named",
    "licensed under the mit license": "mit_named",
    "this project is licensed under the mit license": "mit_named",
    "spdx license identifier mit": "spdx_mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "and associated documentation files the software to deal in the software without restriction "
    "including without limitation the rights to use copy modify merge publish distribute "
    "sublicense and or sell copies of the software and to permit persons to whom the software is "
    "furnished to do so subject to the following conditions": "mit_grant",
    "the above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the software": "mit_notice",
    "the software is provided as is without warranty of any kind": "no_warranty",
    "the software is provided as is without warranty of any kind express or implied including but "
    "not limited to the warranties of merchantability fitness for a particular purpose and "
    "noninfringement": "no_warranty",
    "this work is licensed under the gnu general public license version 3": "gpl_3_named",
    "licensed under the gnu general public license version 3": "gpl_3_named",
    "licensed under the gnu general public license version 2": "gpl_2_named",
    "this program is free software you can redistribute it and or modify it under the terms of "
    "the gnu general public license as published by the free software foundation either version 3 "
    "of the license or at your option any later version": "gpl_3_or_later_grant",
    "this program is free software you can redistribute it and or modify it under the terms of "
    "the gnu general public license as published by the free software foundation either version 2 "
    "of the license or at your option any later version": "gpl_2_or_later_grant",
    "this program is distributed in the hope that it will be useful but without any warranty "
    "without even the implied warranty of merchantability or fitness for a particular "
    "purpose": "gpl_no_warranty",
    "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met": "bsd_grant",
    "redistributions of source code must retain the above copyright notice this list of "
    "conditions and the following disclaimer": "bsd_source",
    "redistributions in binary form must reproduce the above copyright notice this list of "
    "conditions and the following disclaimer in the documentation and or other materials provided "
    "with the distribution": "bsd_binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written "
    "permission": "bsd_no_endorsement",
    "licensed under cc by 4 0": "cc_by_4_named",
    "licensed under cc by sa 4 0": "cc_by_sa_4_named",
    "licensed under cc by nc 4 0": "cc_by_nc_4_named",
    "licensed under a creative commons attribution 4 0 international license": "cc_by_4_named",
    "this work is licensed under a creative commons attribution 4 0 international "
    "license": "cc_by_4_named",
    "all rights reserved": "all_rights_reserved",
}

#: Licences and the sequences of identifiers that show them, most specific first.
RULES = [
    ("Apache-2.0", ["apache_2_the_license", "apache_compliance", "apache_obtain"]),
    ("Apache-2.0", ["apache_2_named", "apache_compliance", "apache_obtain"]),
    ("Apache-2.0", ["apache_2_named", "apache_compliance"]),
    ("MIT", ["mit_named", "mit_grant", "mit_notice", "no_warranty"]),
    ("MIT", ["mit_grant", "mit_notice", "no_warranty"]),
    ("MIT", ["mit_grant", "mit_notice"]),
    ("GPL-3.0-or-later", ["gpl_3_or_later_grant", "gpl_no_warranty"]),
    ("GPL-2.0-or-later", ["gpl_2_or_later_grant", "gpl_no_warranty"]),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_no_endorsement"]),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary"]),
    ("GPL-3.0-or-later", ["gpl_3_or_later_grant"]),
    ("GPL-2.0-or-later", ["gpl_2_or_later_grant"]),
    ("Apache-2.0", ["apache_2_named"]),
    ("Apache-2.0", ["spdx_apache_2"]),
    ("MIT", ["mit_named"]),
    ("MIT", ["spdx_mit"]),
    ("GPL-3.0", ["gpl_3_named"]),
    ("GPL-2.0", ["gpl_2_named"]),
    ("CC-BY-4.0", ["cc_by_4_named"]),
    ("CC-BY-SA-4.0", ["cc_by_sa_4_named"]),
    ("CC-BY-NC-4.0", ["cc_by_nc_4_named"]),
]

#: Where a sentence ends: a line's end, or a full stop, colon or like mark before white space.
SENTENCE_END = "[.!?:;][ \\t\\r\\n]+|\\n+"
#: Where every sentence ends: a full stop or like mark before white space, or an empty line.
HARD_END = "[.!?][ \\t\\r\\n]+|\\n[ \\t\\r]*\\n[ \\t\\r\\n]*"
#: Where a sentence may end or run on.
SOFT_END = "[:;][ \\t\\r\\n]+|\\n"
#: A word that every known sentence holds one of; texts without are not normalised.
HINT = "(?i)licen|permission|warranty|redistribut|rights"


def normalised(sentence: str) -> str:
    """The sentence as the table spells it: ASCII letters and digits, one space between words."""
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def sentence_ids(text: Column, sentences: dict[str, str]) -> Column:
    """The identifiers of the text's known sentences, in order.

    "~" stands for a soft end and "~~" for a hard one. A known sentence begins
    and ends at either and may have soft ones between its words. Of several that
    begin at one place the longest counts.
    """
    known = F.create_map(*[F.lit(x) for pair in sentences.items() for x in pair])
    any_of = "|".join(
        s.replace(" ", "[ ~]") for s in sorted(sentences, key=lambda s: (-len(s), s))
    )
    plain = F.translate(F.lower(text), "~", " ")
    for sought, put in (
        (HARD_END, "~~"),
        (SOFT_END, "~"),
        ("[^a-z0-9~]+", " "),
        (" ?~ ?", "~"),
    ):
        plain = F.regexp_replace(plain, sought, put)
    marked = F.concat(F.lit("~"), F.trim(plain), F.lit("~"))
    found = F.regexp_extract_all(marked, F.lit(f"~({any_of})(?=~)"), F.lit(1))
    ids = F.transform(found, lambda s: known[F.translate(s, "~", " ")])
    return F.when(text.rlike(HINT), ids).otherwise(F.array().cast("array<string>"))


def scan(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sentences: dict[str, str] = SENTENCES,
    rules: list[tuple[str, list[str]]] = RULES,
) -> DataFrame:
    """One row per input row: doc_id, n_sentences, sentence_ids, licences, n_unmatched.

    ``n_sentences`` counts the pieces between all ends (``SENTENCE_END``), so a wrapped sentence
    counts once for each of its lines. Rules apply in their order; each takes every place where its sequence of
    identifiers stands unbroken by other known sentences, and what it took is
    gone for later rules. ``licences`` holds the licences found, sorted, each
    once, and is empty without any. ``n_unmatched`` counts known sentences that no
    rule took. Nulls and empty texts have no sentences. Null doc_ids and
    repeated rows are scanned like any other, an empty table gives no rows, and
    other columns are not read.

    ``sentences`` must be normalised and hold one of the words in ``HINT``.
    """
    odd = [s for s in sentences if normalised(s) != s or not re.search(HINT, s)]
    if odd:
        raise ValueError(f"sentences that cannot be found: {odd}")
    # Identifiers stand between marks, each with its own two, so that sequences can touch.
    ordered = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                F.lit("".join(f"<{i}>" for i in ids)).alias("ids"),
            )
            for name, ids in rules
        ]
    )
    found = texts(df, id_col, text_col).select(
        "doc_id",
        F.size(F.filter(F.split("text", SENTENCE_END), lambda s: F.trim(s) != "")).alias(
            "n_sentences"
        ),
        sentence_ids(F.col("text"), sentences).alias("sentence_ids"),
    )
    marked = F.transform("sentence_ids", lambda i: F.concat(F.lit("<"), i, F.lit(">")))
    start = F.struct(
        F.concat_ws("", marked).alias("left"),
        F.array().cast("array<string>").alias("names"),
    )
    # What a rule took leaves a mark, so that its neighbours do not touch.
    matched = F.aggregate(
        ordered,
        start,
        lambda at, rule: F.struct(
            F.replace(at["left"], rule["ids"], F.lit("|")).alias("left"),
            F.when(
                F.contains(at["left"], rule["ids"]), F.array_append(at["names"], rule["name"])
            )
            .otherwise(at["names"])
            .alias("names"),
        ),
    )
    return found.withColumn("matched", matched).select(
        "doc_id",
        "n_sentences",
        "sentence_ids",
        F.array_sort(F.array_distinct("matched.names")).alias("licences"),
        (F.length("matched.left") - F.length(F.translate("matched.left", "<", ""))).alias(
            "n_unmatched"
        ),
    )
