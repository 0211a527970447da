"""Licence lookup by canonical digest.

A text is put into canonical form -- copyright lines dropped, case folded, equivalent spellings
made equal, punctuation and spacing removed -- and its digest is joined to the digests of known
licence texts, each canonicalised the same way. Whole texts are looked up, and every line as a
text of its own (short notices). Whole texts are joined to the tables of known digests, which have
at most ``max_known`` rows and are broadcast, so no document is shuffled; lines look theirs up in a
literal of at most ``max_notices`` entries, since a join of lines would have to be grouped again.

A whole text that has no known digest is looked up once more as a licence file: without its real
copyright notices (a body line that happens to begin with the word stays), leading titles, clause
numbers and the holders' names, against the full licence texts reduced in the same way (those of
``KNOWN_TEXTS`` and of the folder ``license_texts``). The digest column is that of the first form. Only texts that hold
words that such files cannot be without (``telling_words``) are reduced.

Defined results: a null text, or one without letters or digits, has the digest of the empty
string and no licence; repeated rows give repeated rows; other columns pass through whatever their
names, a column named like the result is replaced.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, let

# Texts of short licences and notices (public texts), by SPDX identifier.
KNOWN_TEXTS = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
)

# Spellings that count as equal, as (pattern, replacement) on lower-case text.
EQUIVALENT = (
    (r"licenc", "licens"),
    (r"\bnon-?commercial\b", "noncommercial"),
    (r"\bsub-?license\b", "sublicense"),
    (r"\bcopyright owner", "copyright holder"),
    (r"https?://", ""),
)
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(copyright\b|\(c\)|©)[^\n]*$"

# What every match of a pattern holds: texts with none of it are not searched.
NEEDS = {
    r"licenc": ("licenc",),
    r"\bnon-?commercial\b": ("commercial",),
    r"\bsub-?license\b": ("license",),
    r"\bcopyright owner": ("copyright owner",),
    r"https?://": ("://",),
    COPYRIGHT_LINE: ("copyright", "(c)", "©"),
}

FULL_LENGTH = 200  # known texts longer than this are full licence texts
MAX_LISTS, LIST_WORDS = 32, 4  # lists of telling words of licence files, words of a list
_WRITTEN = ("licens", "noncommercial", "holder")  # parts that the rules write into words

# BSD texts as (SPDX identifier, clauses); the other full texts are files.
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n",
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\n",
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
)
BSD_TEXTS = (("BSD-2-Clause", _BSD[0] + _BSD[1] + _BSD[3]), ("BSD-3-Clause", "".join(_BSD)))

# What a licence file may have around the licence, on lower-case lines: notices (the word with a sign, a
# year, a placeholder or "by"; or alone in its paragraph) and the reservation of rights.
NOTICES = (
    (r"\r\n?", "\n"),
    (r"(?m)^[^\p{L}\p{N}\n]*(?:portions )?(?:copyright\b[^\p{L}\p{N}\n]*(?:\(c\)|©|c\b|(?:19|20)\d\d|[<\[{]|by\b)|©"
     r"|\(c\)[^\p{L}\p{N}\n]*(?:copyright\b|(?:19|20)\d\d|[<\[{]))[^\n]*$", ""),
    (r"(?m)^[^\p{L}\p{N}\n]*all rights reserved[^\p{L}\p{N}\n]*$", ""),
    (r"(^|\n[^\p{L}\p{N}\n]*\n)[^\p{L}\p{N}\n]*copyright\b[^\n]*(?=\n[^\p{L}\p{N}\n]*(?:\n|$)|$)", "$1"),
)
# The same on canonical words: titles, clause numbers, holders' names, postal addresses.
_MONTH = "january|february|march|april|may|june|july|august|september|october|november|december"
FRAME = (
    (r"^(?:(?:[\p{L}\p{N}]+ ){0,6}?license(?: (?:identifier|agreement|text|file|mit|isc|expat|x11|bsd|0bsd|new|revised|modified"
     r"|simplified|[234] clause|v\d+|version \d+(?: \d\d?)?|(?:" + _MONTH + r") \d{4}|www apache org licenses))*(?: |$))+", ""),
    (r"^(?:the )?(?:mit|isc|expat|x11|0bsd|zero clause bsd|(?:[23]|two|three) clause bsd|bsd (?:[23]|two|three) clause|bsd) "
     r"(?=permission |redistribution )", ""),
    (r"\b(?:[1-4]|[a-d]|i{1,3}) (?=redistributions (?:of|in) |neither the name)", ""),
    (r"\bneither the names? of .{1,120}? nor the names? of (?:its |their |any |the )?contributors", "neither holder nor contributors"),
    (r"\bthis software is provided by .{1,120}? as is and", "this software is provided as is and"),
    (r"\bin no event shall .{1,120}? be liable", "in no event shall be liable"),
    (r"\b(?:59 temple place|51 franklin st(?:reet)?|675 mass ave)[^0-9]*(?:330 )?[^0-9]*\d{5}(?: \d{4,5})?(?: usa)?", ""),
)


def full_texts() -> tuple:
    """``(license_id, body)`` of the full texts beyond ``KNOWN_TEXTS``, with and without what follows their end line."""
    got = list(BSD_TEXTS)
    for f in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        body, mark = f.read_text("utf-8"), "END OF TERMS AND CONDITIONS"
        head, found, _ = body.partition(mark)
        got += [(f.stem, x) for x in ((body, head, head + mark) if found else (body,))]
    return tuple(got)


def _any(text: Column, words) -> Column:
    return reduce(or_, (text.contains(w) for w in words), F.lit(False))


def _replaced(t: Column, pattern: str, to: str) -> Column:
    if pattern not in NEEDS:
        return F.regexp_replace(t, pattern, to)
    return let(t, lambda v: F.when(_any(v, NEEDS[pattern]), F.regexp_replace(v, pattern, to)).otherwise(v))


def _lower(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def _words_by_line(low: Column) -> Column:
    """Canonical lines of a lower-case text, not trimmed. No rule reaches beyond a line, so they are those of each line by itself."""
    t = low
    for pattern, to in ((COPYRIGHT_LINE, " "), *EQUIVALENT):
        t = _replaced(t, pattern, to)
    return F.regexp_replace(t, r"[^\p{L}\p{N}\n]+", " ")


def _joined(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r" ?\n[ \n]*", " "))


def canonical(text: Column) -> Column:
    """Canonical form of a text (a Column of built-in functions)."""
    return _joined(_words_by_line(_lower(text)))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def _body(low: Column) -> Column:
    t = low
    for pattern, to in (*NOTICES, *EQUIVALENT):
        t = _replaced(t, pattern, to)
    t = F.trim(F.regexp_replace(t, r"[^\p{L}\p{N}]+", " "))
    for pattern, to in FRAME:
        t = F.regexp_replace(t, pattern, to)
    return F.trim(F.regexp_replace(t, " +", " "))


def licence_body(text: Column) -> Column:
    """Canonical form of a licence file without notices, titles and names."""
    return _body(_lower(text))


def body_digest(text: Column) -> Column:
    return F.sha2(licence_body(text), 256)


def known_digests(spark, texts=KNOWN_TEXTS, of=digest) -> DataFrame:
    """``(digest, license_id)``, one row per distinct canonical text; as many rows as ``texts`` at most."""
    raw = spark.createDataFrame(list(texts), "license_id string, body string")
    return (raw.select(of(F.col("body")).alias("digest"), "license_id")
            .groupBy("digest").agg(F.min("license_id").alias("license_id")))


def telling_words(spark, files) -> list[list[str]] | None:
    """Short lists of words; every text whose ``licence_body`` equals that of one of the ``files`` holds all words of
    one list, once web prefixes are deleted (None: the lists would be too many).

    The rules only delete whole words and lines, except that they delete web prefixes inside words and write the parts
    of ``_WRITTEN``; so an ASCII word without such a part stands in the text if it stands in the body. Each file goes by
    its word of 12 letters or more (if none, its longest) that is in most files; files that go by one word make a
    list of words that all of them hold.
    """
    word = F.explode(F.array_distinct(F.split(licence_body(F.col("body")), " "))).alias("word")
    rows = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(files)], "file long, body string").select("file", word)
    rows = rows.where(F.col("word").rlike("^[a-z]+$") & ~_any(F.col("word"), _WRITTEN))
    common = rows.groupBy("word").agg(F.count("*").alias("n"))
    rank = [F.least(F.length("word"), F.lit(12)), "n", F.length("word"), "word"]
    lead = rows.join(common, "word").groupBy("file").agg(F.max_by("word", F.struct(*rank)).alias("lead"))
    size = lead.groupBy("lead").agg(F.count("*").alias("files"))
    shared = (rows.join(lead, "file").groupBy("lead", "word").agg(F.count("*").alias("n")).join(size, "lead").where("n = files")
              .groupBy("lead", "files").agg(F.slice(F.sort_array(F.collect_list(F.struct(*rank)), False), 1, LIST_WORDS).alias("top")))
    got = shared.select("lead", "files", F.array_union(F.array("lead"), F.col("top.word")).alias("words")).orderBy("lead").limit(MAX_LISTS + 1).collect()
    short = len(got) <= MAX_LISTS and sum(r["files"] for r in got) == len(files)  # a file without such a word goes by none
    return [r["words"] for r in got] if short else None


def scan(df: DataFrame, text: str = "text", texts=KNOWN_TEXTS, out: str = "license",
         max_known: int = 100_000, notices=None, max_notices: int = 1_000) -> DataFrame:
    """``df`` with a struct column ``out``: ``digest`` of the whole text, ``license_id`` it equals
    (null: none; a licence file counts with its notices and titles), ``notices`` (sorted licence ids of lines that are a known text as a whole).

    ``texts`` are ``(license_id, body)``; ``notices`` are those that count as a line (None: all of ``texts``).
    Both have a stated bound; more raises ``ValueError``.
    """
    spark = df.sparkSession
    notices = texts if notices is None else notices
    files = [(i, t) for i, t in (*texts, *full_texts()) if len(t) > FULL_LENGTH]
    for name, known, bound in (("known texts", texts, max_known), ("licence files", files, 2 * max_known), ("notices", notices, max_notices)):
        if len(known) > bound:
            raise ValueError(f"{len(known)} {name} exceed the bound {bound}")

    rest = [c for c in df.columns if c.lower() != out.lower()]
    low, shown, whole, body, lines, in_texts, of_text, in_files, of_file = (free_name(df, n) for n in (
        "lower_text", "shown_lines", "whole_digest", "body_digest", "line_ids", "known_text", "text_license", "known_file", "file_license"))
    found = {r["digest"]: r["license_id"] for r in known_digests(spark, notices).collect()}
    entries = [F.lit(x) for kv in sorted(found.items()) for x in kv]
    lookup = F.create_map(*entries) if entries else F.create_map().cast("map<string,string>")
    sizes = sorted({r[0] for r in spark.createDataFrame(list(notices), "license_id string, body string")
                    .select(F.octet_length(canonical(F.col("body")))).distinct().collect()})
    # a text goes by its lower-case form and its canonical lines, each made once
    shaped = df.select(*[df[c] for c in rest], _lower(df[text]).alias(low))
    shaped = shaped.select("*", _words_by_line(F.col(low)).alias(shown))
    each = F.filter(F.transform(F.split(shown, "\n"), lambda x: F.trim(x)), lambda x: F.octet_length(x).isin(sizes))
    ids = F.filter(F.transform(F.array_distinct(each), lambda x: F.element_at(lookup, F.sha2(x, 256))), lambda x: x.isNotNull())
    words = telling_words(spark, files)
    as_file = F.sha2(_body(F.col(low)), 256)
    if words is not None:
        all_of = lambda v, some: reduce(and_, (v.contains(w) for w in some))
        one_list = lambda v: reduce(or_, (all_of(v, some) for some in words), F.lit(False))
        as_file = F.when(let(_replaced(F.col(low), r"https?://", ""), one_list), as_file)
    digests = shaped.select(*[f"`{c}`" for c in rest], F.sha2(_joined(F.col(shown)), 256).alias(whole), as_file.alias(body),
                            F.array_sort(F.array_distinct(ids)).alias(lines))
    by_text = known_digests(spark, texts).toDF(in_texts, of_text)
    by_body = known_digests(spark, files, body_digest).toDF(in_files, of_file)
    met = (digests.join(F.broadcast(by_text), F.col(whole) == F.col(in_texts), "left")
           .join(F.broadcast(by_body), F.col(body) == F.col(in_files), "left"))
    return met.select(*[f"`{c}`" for c in rest], F.struct(
        F.col(whole).alias("digest"), F.coalesce(of_text, of_file).alias("license_id"), F.col(lines).alias("notices")).alias(out))
