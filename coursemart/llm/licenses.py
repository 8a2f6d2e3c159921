"""License scans by canonical digests, in DataFrame and SQL functions only.

A text is brought to a canonical form: lower case, anything but letters and digits as a blank, equivalent spellings as one, lines
that only say whose copyright it is left out, line breaks as blanks. The digest of the whole form is hash-joined to the digests of known
license texts, and so is the digest of each single line, since many works carry a notice line instead of the text.

Defined cases: NULL and empty texts match nothing. Rows that repeat an id (or have none) share what is found in any of them. Of several
known texts with one digest the first id counts. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemart.llm.common import literal_rows
from coursemart.session import materialise

#: Spellings taken as one: from, to. Fixed values; single words or words with one blank between them.
EQUIVALENTS = (
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"),
    ("favour", "favor"),
    ("fulfil", "fulfill"),
    ("https", "http"),
    ("licence", "license"),
    ("licenced", "licensed"),
    ("licences", "licenses"),
    ("merchantibility", "merchantability"),
    ("non infringement", "noninfringement"),
    ("organisation", "organization"),
    ("per cent", "percent"),
    ("sub license", "sublicense"),
    ("whilst", "while"),
)

_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)

#: License id, text or notice line. Fixed values; a longer table can be given instead.
KNOWN = (
    (
        "MIT",
        "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
        "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
        "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _AS_IS,
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."
        "\n\n" + _AS_IS,
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("all-rights-reserved", "All rights reserved."),
)


def canonical_lines(text: Column) -> Column:
    """The lines of a text in canonical form, without empty ones."""
    plain = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " ")
    # Two blanks between words, so that each word has blanks of its own to be found by.
    body = F.concat(F.lit(" "), F.replace(F.replace(plain, F.lit("\n"), F.lit(" \n ")), F.lit(" "), F.lit("  ")), F.lit(" "))
    for old, new in EQUIVALENTS:
        a, b = (f" {x.replace(' ', '  ')} " for x in (old, new))
        body = F.replace(body, F.lit(a), F.lit(b))
    lines = F.transform(F.split(body, "\n"), lambda x: F.regexp_replace(F.trim(x), " +", " "))
    return F.filter(lines, lambda x: x != "")


def canonical(lines: Column) -> Column:
    """The whole canonical form, without lines that name a copyright's year or holder."""
    owner = r"^(copyright c |(copyright|c) ([0-9]{4}|year)\b)"
    return F.array_join(F.filter(lines, lambda x: ~F.regexp_like(x, F.lit(owner))), " ")


def digest(form: Column) -> Column:
    return F.when(form != "", F.sha2(form.cast("binary"), 256))


def known_digests(spark, known: Sequence[tuple[str, str]] = KNOWN) -> DataFrame:
    """(digest, license_id) of the known texts."""
    rows = literal_rows(spark, list(known), ["license_id", "text"], ["string", "string"])
    forms = rows.select("license_id", digest(canonical(canonical_lines(F.col("text")))).alias("digest"))
    return forms.where("digest IS NOT NULL").groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan_licenses(
    docs: DataFrame, key: str = "doc_id", text: str = "text", known: Sequence[tuple[str, str]] = KNOWN
) -> DataFrame:
    """One row per row of ``docs``: key, the license that its entire text is (or NULL), the licenses that single lines name and the number of
    such lines. A text of one line that is known is both."""
    lines = docs.select(F.col(key).alias("_key"), canonical_lines(F.col(text)).alias("lines"))
    # Place 0 is the whole text, the lines follow.
    forms = F.concat(F.array(canonical(F.col("lines"))), F.col("lines"))
    units = lines.select("_key", F.posexplode(forms).alias("place", "form"))
    table = known_digests(docs.sparkSession, known)
    hits = (
        units.select("_key", "place", digest(F.col("form")).alias("digest"))
        .join(table, "digest")
        .groupBy("_key")
        .agg(
            F.min(F.when(F.col("place") == 0, F.col("license_id"))).alias("license_id"),
            F.array_join(F.sort_array(F.collect_set(F.when(F.col("place") > 0, F.col("license_id")))), ",").alias("notices"),
            F.count_if(F.col("place") > 0).alias("n_notices"),
        )
    )
    # Written, so that the join reads two scans and the rows of a frequent id can be split.
    hits = materialise(hits, "licenses")
    return docs.select(F.col(key)).join(hits, F.col(key).eqNullSafe(F.col("_key")), "left").select(
        key,
        "license_id",
        F.coalesce("notices", F.lit("")).alias("notices"),
        F.coalesce("n_notices", F.lit(0).cast("long")).alias("n_notices"),
    )
