"""Licence scan: an entire text, brought to a canonical form, is looked up by digest among known licences.

A text is a whole document, a block between blank lines, or a line. Nothing is matched in part.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendmill.llm.license_texts import KNOWN

# Spellings that count as equal, as whole words of the form without punctuation.
EQUIVALENT = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("licencee", "licensee"), ("licencees", "licensees"),
    ("licencing", "licensing"), ("sublicences", "sublicenses"), ("sublicenced", "sublicensed"), ("sublicencing", "sublicensing"),
    ("licensor", "licenser"),
    ("sub license", "sublicense"), ("sub licence", "sublicense"), ("sublicence", "sublicense"),
    ("non infringement", "noninfringement"), ("non commercial", "noncommercial"),
    ("merchantibility", "merchantability"), ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"), ("favour", "favor"), ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"), ("organisations", "organizations"), ("per cent", "percent"),
    ("whilst", "while"), ("wilful", "willful"), ("fulfil", "fulfill"), ("https", "http"), ("v", "version"),
)
# A line that only says who holds the rights, and when; comment marks may stand before it. It names a year, a sign or a
# placeholder, which a sentence about copyright does not.
COPYRIGHT_LINE = (
    r"(^|\n)[ \t#*/;%!|<>.\-]*(?i:(?:portions[ \t]+)?copyright[ \t,:]*(?:\(c\)|©|[0-9]{4}|<|\[|\{)"
    r"|(?:portions[ \t]+)?copyright[ \t]+[^\n]*(?:19|20)[0-9]{2}|\(c\)[ \t]*[0-9]{4}|©|all rights reserved)[^\n]*"
)
# Every known text has one of these, in any spelling that counts as equal; a text without them is no licence.
ANCHOR = r"(?i)licen[cs]|permission|redistribution"


def canonical(text: str) -> str:
    """The canonical form of one text, for the known ones; ``canonical_column`` does the same for a column."""
    text = re.sub(COPYRIGHT_LINE, "\n", text)
    text = re.sub(r"[^A-Za-z0-9]+", " ", text).lower()
    text = f" {text.strip()} "
    for spelling, same in EQUIVALENT:
        text = text.replace(f" {spelling} ", f" {same} ")
    return text.strip()


def canonical_column(text: Column) -> Column:
    """Without copyright lines, other than ASCII letters and digits as single spaces, lower case, one spelling."""
    text = F.regexp_replace(text, COPYRIGHT_LINE, "\n")
    text = F.lower(F.regexp_replace(text, r"[^A-Za-z0-9]+", " "))
    text = F.concat(F.lit(" "), F.btrim(text), F.lit(" "))
    for spelling, same in EQUIVALENT:
        text = F.replace(text, F.lit(f" {spelling} "), F.lit(f" {same} "))
    return F.btrim(text)


def known_digests(known=KNOWN) -> list[tuple[str, str]]:
    """(digest, identifier) of each known text, once. Two licences with one canonical text would be an error."""
    found: dict[str, str] = {}
    for name, text in known:
        digest = hashlib.sha256(canonical(text).encode()).hexdigest()
        if found.setdefault(digest, name) != name:
            raise ValueError(f"{name} and {found[digest]} have the same canonical text")
    return sorted(found.items())


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", known=KNOWN) -> DataFrame:
    """The texts that are a known licence: doc_id, scope (document, block or line), unit (from 0), license_id, digest.

    A one-line document that is a licence gives three rows, one for each scope; repeated rows of the input repeat
    theirs. Null and empty texts match nothing, a null doc_id is carried along, and no other column is read.
    ``known`` is fixed and small: its digests are the broadcast side.
    """
    spark = docs.sparkSession
    listed = spark.createDataFrame(known_digests(known), "digest string, license_id string")
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("t")) \
        .filter(F.regexp_like("t", F.lit(ANCHOR)))

    def units(scope: str, parts: Column) -> Column:
        return F.transform(parts, lambda x, i: F.struct(
            F.lit(scope).alias("scope"), i.cast("long").alias("unit"), x.alias("x")))

    parts = source.select("doc_id", F.explode(F.filter(F.concat(
        units("document", F.array("t")),
        units("block", F.split("t", r"\n[ \t\r]*\n")),
        units("line", F.split("t", "\n")),
    ), lambda u: F.regexp_like(u["x"], F.lit(ANCHOR)))).alias("u"))
    digests = parts.select("doc_id", "u.scope", "u.unit", F.sha2(canonical_column(F.col("u.x")), 256).alias("digest"))
    return digests.join(F.broadcast(listed), "digest").select("doc_id", "scope", "unit", "license_id", "digest")


def scan_sql(source: str, known=KNOWN) -> str:
    """DuckDB SQL for the same rows."""
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    form = f"regexp_replace(x, {quoted(COPYRIGHT_LINE)}, chr(10), 'g')"
    form = f"' ' || trim(lower(regexp_replace({form}, '[^A-Za-z0-9]+', ' ', 'g'))) || ' '"
    for spelling, same in EQUIVALENT:
        form = f"replace({form}, ' {spelling} ', ' {same} ')"
    values = ", ".join(f"({quoted(digest)}, {quoted(name)})" for digest, name in known_digests(known))
    return f"""
    with source as (
        select doc_id, text as t from {source} where regexp_matches(text, '{ANCHOR}')
    ), units as (
        select doc_id, 'document' as scope, [t] as parts from source
        union all select doc_id, 'block', string_split_regex(t, '\\n[ \\t\\r]*\\n') from source
        union all select doc_id, 'line', string_split(t, chr(10)) from source
    ), parts as (
        select doc_id, scope, unnest(range(len(parts))) as unit, unnest(parts) as x from units
    ), digests as (
        select doc_id, scope, unit, sha256(trim({form})) as digest from parts where regexp_matches(x, '{ANCHOR}')
    )
    select doc_id, scope, unit, license_id, digest
    from digests join (values {values}) as known(digest, license_id) using (digest)"""
