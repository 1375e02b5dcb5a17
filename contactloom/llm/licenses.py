"""License scan: sentences to identifiers, identifier sequences to licenses.

A text is cut into sentences at blank lines and sentence ends; comment marks at the ends of
lines are taken off and wrapped lines joined. The known license sentences become identifiers;
they begin and end at a sentence end, a colon, a semicolon or a line break that is no wrap. So
do the names in SPDX tags. Ordered rules are then matched against the sequence of identifiers:
a rule that finds its identifiers one after another names a license and takes them out, so
long rules come before the short ones that they contain.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words without which no sentence is about a license.
CRITICAL = (r"licen[cs]e|copyright|permission|warrant|redistribut|spdx|public domain|cc by|"
            r"cc-by|cc0|all rights reserved")
# Openings that say only what is licensed.
OPENING = (r"^(this|the) (work|file|software|project|program|code|source code|text|document|"
           r"documentation|page|article|content|material|data|dataset|library|package) is ")

# Normalised license sentences and their identifiers.
SENTENCES = {
    "licensed under the apache license version 2.0": "ApacheGrant",
    "licensed under the apache license version 2.0 the license": "ApacheGrant",
    "released under the apache license version 2.0": "ApacheGrant",
    "licensed under the apache license 2.0": "ApacheGrant",
    "apache license version 2.0": "ApacheGrant",
    "you may not use this file except in compliance with the license": "ApacheUse",
    "you may obtain a copy of the license at http www.apache.org licenses license-2.0":
        "ApacheCopy",
    "you may obtain a copy of the license at https www.apache.org licenses license-2.0":
        "ApacheCopy",
    "unless required by applicable law or agreed to in writing software distributed under the "
    "license is distributed on an as is basis without warranties or conditions of any kind "
    "either express or implied": "ApacheAsIs",
    "see the license for the specific language governing permissions and limitations under "
    "the license": "ApacheTerms",
    "released under the mit license": "MitGrant",
    "licensed under the mit license": "MitGrant",
    "the mit license": "MitGrant",
    "mit license": "MitGrant",
    "distributed under the mit license": "MitGrant",
    "permission is hereby granted free of charge to any person obtaining a copy of this "
    "software and associated documentation files the software to deal in the software without "
    "restriction including without limitation the rights to use copy modify merge publish "
    "distribute sublicense and or sell copies of the software and to permit persons to whom "
    "the software is furnished to do so subject to the following conditions": "MitPermission",
    "the above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the software": "MitNotice",
    "provided as is without warranty of any kind express or implied including but not limited "
    "to the warranties of merchantability fitness for a particular purpose and noninfringement":
        "MitAsIs",
    "licensed under the gnu general public license version 2": "Gpl2Grant",
    "licensed under the gnu general public license version 3": "Gpl3Grant",
    "released under the gnu general public license version 2": "Gpl2Grant",
    "released under the gnu general public license version 3": "Gpl3Grant",
    "licensed under the gnu lesser general public license version 2.1": "Lgpl21Grant",
    "licensed under the gnu lesser general public license version 3": "Lgpl3Grant",
    "licensed under the gnu affero general public license version 3": "Agpl3Grant",
    "free software you can redistribute it and or modify it under the terms of the gnu general "
    "public license as published by the free software foundation either version 2 of the "
    "license or at your option any later version": "Gpl2LaterGrant",
    "free software you can redistribute it and or modify it under the terms of the gnu general "
    "public license as published by the free software foundation either version 3 of the "
    "license or at your option any later version": "Gpl3LaterGrant",
    "distributed in the hope that it will be useful but without any warranty without even the "
    "implied warranty of merchantability or fitness for a particular purpose": "GplNoWarranty",
    "see the gnu general public license for more details": "GplDetails",
    "you should have received a copy of the gnu general public license along with this program":
        "GplCopy",
    "subject to the terms of the mozilla public license v. 2.0": "Mpl2Grant",
    "this source code form is subject to the terms of the mozilla public license v. 2.0":
        "Mpl2Grant",
    "licensed under the mozilla public license version 2.0": "Mpl2Grant",
    "licensed under the bsd license": "BsdGrant",
    "released under the bsd license": "BsdGrant",
    "licensed under the bsd 2-clause license": "Bsd2Grant",
    "licensed under the bsd 3-clause license": "Bsd3Grant",
    "redistribution and use in source and binary forms with or without modification are "
    "permitted provided that the following conditions are met": "BsdConditions",
    "redistributions of source code must retain the above copyright notice this list of "
    "conditions and the following disclaimer": "BsdSource",
    "redistributions in binary form must reproduce the above copyright notice this list of "
    "conditions and the following disclaimer in the documentation and or other materials "
    "provided with the distribution": "BsdBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written "
    "permission": "BsdNames",
    "permission to use copy modify and or distribute this software for any purpose with or "
    "without fee is hereby granted provided that the above copyright notice and this "
    "permission notice appear in all copies": "IscPermission",
    "licensed under the isc license": "IscGrant",
    "licensed under the boost software license version 1.0": "BoostGrant",
    "licensed under the eclipse public license version 2.0": "Epl2Grant",
    "dedicated to the public domain": "PublicDomain",
    "in the public domain": "PublicDomain",
    "free and unencumbered software released into the public domain": "Unlicense",
    "licensed under cc0 1.0": "Cc0Grant",
    "all rights reserved": "AllRights",
}
# Licenses and the identifiers that make them up, in the order of the rules.
RULES = [
    ("Apache-2.0", ("ApacheGrant", "ApacheUse", "ApacheCopy", "ApacheAsIs", "ApacheTerms")),
    ("Apache-2.0", ("ApacheUse", "ApacheCopy", "ApacheAsIs", "ApacheTerms")),
    ("Apache-2.0", ("ApacheGrant",)),
    ("MIT", ("MitGrant", "MitPermission", "MitNotice", "MitAsIs")),
    ("MIT", ("MitPermission", "MitNotice", "MitAsIs")),
    ("MIT", ("MitPermission", "MitNotice")),
    ("MIT", ("MitGrant",)),
    ("GPL-2.0-or-later", ("Gpl2LaterGrant", "GplNoWarranty", "GplDetails", "GplCopy")),
    ("GPL-2.0-or-later", ("Gpl2LaterGrant",)),
    ("GPL-3.0-or-later", ("Gpl3LaterGrant", "GplNoWarranty", "GplDetails", "GplCopy")),
    ("GPL-3.0-or-later", ("Gpl3LaterGrant",)),
    ("GPL-2.0", ("Gpl2Grant",)),
    ("GPL-3.0", ("Gpl3Grant",)),
    ("LGPL-2.1", ("Lgpl21Grant",)),
    ("LGPL-3.0", ("Lgpl3Grant",)),
    ("AGPL-3.0", ("Agpl3Grant",)),
    ("MPL-2.0", ("Mpl2Grant",)),
    ("BSD-3-Clause", ("BsdConditions", "BsdSource", "BsdBinary", "BsdNames")),
    ("BSD-2-Clause", ("BsdConditions", "BsdSource", "BsdBinary")),
    ("BSD-3-Clause", ("Bsd3Grant",)),
    ("BSD-2-Clause", ("Bsd2Grant",)),
    ("BSD", ("BsdGrant",)),
    ("ISC", ("IscPermission",)),
    ("ISC", ("IscGrant",)),
    ("BSL-1.0", ("BoostGrant",)),
    ("EPL-2.0", ("Epl2Grant",)),
    ("Unlicense", ("Unlicense",)),
    ("CC0-1.0", ("Cc0Grant",)),
    ("Public-Domain", ("PublicDomain",)),
]
# The attribution licenses, of which there is one for each kind and version.
for _kind, _version in product(("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd"),
                               ("1.0", "2.0", "2.5", "3.0", "4.0")):
    _id = f"Cc-{_kind}-{_version}"
    for _verb in ("licensed", "released"):
        SENTENCES[f"{_verb} under cc {_kind} {_version}"] = _id
        SENTENCES[f"{_verb} under cc-{_kind}-{_version}"] = _id
    RULES.append((f"CC-{_kind.upper()}-{_version}", (_id,)))


# What whole notices hold besides; the SQL counterpart does not know these.
NOTICE_SENTENCES = {
    "permission to use copy modify and distribute this software for any purpose with or "
    "without fee is hereby granted provided that the above copyright notice and this "
    "permission notice appear in all copies": "IscPermission",
    "provided as is and the author disclaims all warranties with regard to this software "
    "including all implied warranties of merchantability and fitness": "IscAsIs",
    "in no event shall the authors or copyright holders be liable for any claim damages or "
    "other liability whether in an action of contract tort or otherwise arising from out of or "
    "in connection with the software or the use or other dealings in the software": "MitLiable",
    "provided by the copyright holders and contributors as is and any express or implied "
    "warranties including but not limited to the implied warranties of merchantability and "
    "fitness for a particular purpose are disclaimed": "BsdAsIs",
    "if not see http www.gnu.org licenses": "GplSee",
    "if not see https www.gnu.org licenses": "GplSee",
    "in jurisdictions that recognize copyright laws the author or authors of this software "
    "dedicate any and all copyright interest in the software to the public domain":
        "UnlicenseDedication",
}
for _holder in ("holder", "owner"):
    NOTICE_SENTENCES[
        f"in no event shall the copyright {_holder} or contributors be liable for any direct "
        "indirect incidental special exemplary or consequential damages including but not "
        "limited to procurement of substitute goods or services loss of use data or profits or "
        "business interruption however caused and on any theory of liability whether in "
        "contract strict liability or tort including negligence or otherwise arising in any "
        "way out of the use of this software even if advised of the possibility of such "
        "damage"] = "BsdLiable"
_GPL_REST = ("GplNoWarranty", "GplDetails", "GplCopy")
NOTICE_RULES = [
    ("MIT", ("MitGrant", "MitPermission", "MitNotice", "MitAsIs", "MitLiable")),
    ("MIT", ("MitPermission", "MitNotice", "MitAsIs", "MitLiable")),
    ("BSD-3-Clause", ("BsdConditions", "BsdSource", "BsdBinary", "BsdNames", "BsdAsIs",
                      "BsdLiable")),
    ("BSD-2-Clause", ("BsdConditions", "BsdSource", "BsdBinary", "BsdAsIs", "BsdLiable")),
    ("ISC", ("IscPermission", "IscAsIs")),
    ("Unlicense", ("Unlicense", "UnlicenseDedication")),
    ("GPL-2.0-or-later", ("Gpl2LaterGrant", *_GPL_REST, "GplSee")),
    ("GPL-3.0-or-later", ("Gpl3LaterGrant", *_GPL_REST, "GplSee")),
]
for _kind, _version, _name in (("lesser", "2.1", "LGPL-2.1"), ("lesser", "3", "LGPL-3.0"),
                               ("affero", "3", "AGPL-3.0")):
    _id = _name.replace("-", "") + "LaterGrant"
    NOTICE_SENTENCES |= {
        f"free software you can redistribute it and or modify it under the terms of the gnu "
        f"{_kind} general public license as published by the free software foundation either "
        f"version {_version} of the license or at your option any later version": _id,
        f"see the gnu {_kind} general public license for more details": "GplDetails"}
    NOTICE_RULES += [(f"{_name}-or-later", (_id, *_GPL_REST, "GplSee")),
                     (f"{_name}-or-later", (_id, *_GPL_REST)), (f"{_name}-or-later", (_id,))]
for _kind, _noun in product(("", "lesser ", "affero "), ("program", "library", "software")):
    NOTICE_SENTENCES[f"you should have received a copy of the gnu {_kind}general public "
                     f"license along with this {_noun}"] = "GplCopy"

# Names in SPDX tags: those of the rules, and other ways to write them.
SPDX_NAMES = {name.lower(): name for name, _ in (*RULES, *NOTICE_RULES)}
for _name in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0"):
    SPDX_NAMES |= {f"{_name}-only".lower(): _name, f"{_name}+".lower(): f"{_name}-or-later"}
# The notices hold the sequences of other rules, so their rules come first.
ALL_RULES = NOTICE_RULES + RULES + [(name, (f"Spdx-{name}",))
                                    for name in dict.fromkeys(SPDX_NAMES.values())]

# Fits every text that has a critical word, also one that is broken over lines.
LIKELY = (r"licen[cs]e|copyright|permission|warrant|redistribut|spdx|"
          r"public[^a-z0-9]+domain|cc[^a-z0-9]+by|cc0|all[^a-z0-9]+rights[^a-z0-9]+reserved")
CRITICAL_WORD, ANY_OPENING = re.compile(CRITICAL), re.compile(OPENING + "|^this is ")
LINE = re.compile(r"\r\n?|\n")
LINE_START = re.compile(
    r"(?:(?:<!--+|/\*+|\*+/?|//+|#+|;+|--+>?|%+|\(\*+|dnl(?=\s)|[-•](?=\s))[ \t\f]*)+")
LINE_END = re.compile(r"[ \t\f]*(?:\*+[/)]?|--+>|#+)?[ \t\f]*$")
SPDX_TAG = re.compile(
    r"spdx-license-identifier[ \t]*:[ \t(]*([a-z0-9.+-]+[ \t)]*"
    r"(?:\b(?:and|or|with)[ \t]+[ \t(]*[a-z0-9.+-]+[ \t)]*)*)", re.I)
SPDX_PART = re.compile(r"(?:\bwith[ \t(]+)?[a-z0-9.+-]+")
# Version numbers follow "v.", so it ends no sentence.
SENTENCE_END = re.compile(r"(?:(?<=[.!?])(?<!\bv\.)|(?<=[.!?][\"')\]]))\s+")
WORD = re.compile(r"[a-z0-9.+-]+")
CLAUSE_END = re.compile(r"[\n;:]")


def known_sentences() -> dict[str, list[tuple[list[str], str]]]:
    """Words and identifier of the known sentences by their first word, long ones first."""
    out = defaultdict(list)
    for sentence, name in sorted((SENTENCES | NOTICE_SENTENCES).items(),
                                 key=lambda known: -len(known[0].split())):
        words = sentence.split()
        out[words[0]].append((words, name))
    return out


KNOWN = known_sentences()


def joined(lines: list[str]) -> str:
    """Lines of a paragraph with a blank where a line is wrapped: the next one goes on in small
    letters, and its first word had no place. Other line breaks stay."""
    width = max(map(len, lines))
    out = lines[:1]
    for before, line in zip(lines, lines[1:]):
        wrapped = line[0].islower() and len(before) + 1 + len(line.split()[0]) > width
        out += [" " if wrapped else "\n", line]
    return "".join(out).lower()


def paragraphs(text: str) -> Iterator[str]:
    """Lower-cased paragraphs without comment marks; SPDX tags are paragraphs of their own. A
    blank line before an address, as in notices that set it off, ends none."""
    lines: list[str] = []
    blank = False
    for line in LINE.split(text):
        line = line.strip()
        line = LINE_END.sub("", line[found.end():] if (found := LINE_START.match(line))
                            else line).strip()
        if not line:
            blank = True
            continue
        if blank and lines and not (line.lower().startswith(("http:", "https:"))
                                    and lines[-1][-1] not in ".!?"):
            yield joined(lines)
            lines = []
        blank = False
        while tag := SPDX_TAG.search(line):
            if before := line[:tag.start()].strip():
                lines.append(before)
            if lines:
                yield joined(lines)
                lines = []
            yield tag[0].lower()
            line = line[tag.end():].strip()
        if line:
            lines.append(line)
    if lines:
        yield joined(lines)


def spdx_identifiers(tag: str) -> tuple[list[str], bool]:
    """Identifiers of the names in an SPDX expression, and whether all of them are known;
    exceptions after ``with`` name no license."""
    names = [p.rstrip(".") for p in SPDX_PART.findall(SPDX_TAG.match(tag)[1])
             if p not in ("and", "or") and not re.match(r"with[ \t(]", p)]
    found = [f"Spdx-{SPDX_NAMES[n]}" for n in names if n in SPDX_NAMES]
    return found, len(found) == len(names)


def sentence_identifiers(sentence: str) -> tuple[list[str], int]:
    """Identifiers of the known sentences in a sentence, from left to right and the longest
    first, and how many stretches with a critical word are left."""
    spans = [(w.start(), w.end()) for w in WORD.finditer(sentence) if w[0].strip(".")]
    words = [sentence[a:b] for a, b in spans]
    ends = [bool(CLAUSE_END.search(sentence, a[1], b[0])) for a, b in zip(spans, spans[1:])]
    ends.append(True)
    found, unknown, at, left = [], 0, 0, 0

    def rest(until: int) -> int:
        return int(left < until and CRITICAL_WORD.search(
            sentence[spans[left][0]:spans[until - 1][1]].replace("\n", " ")) is not None)

    while at < len(words):
        after = 0
        if at == 0 or ends[at - 1]:
            opening = ANY_OPENING.match(" ".join(words[at:at + 4]) + " ")
            begins = (at + len(opening[0].split()), at) if opening else (at,)
            for begin in begins:
                for known, name in KNOWN.get(words[begin] if begin < len(words) else "", ()):
                    last = begin + len(known) - 1
                    if (last < len(words) and ends[last] and words[begin:last] == known[:-1]
                            and words[last].rstrip(".") == known[-1]):
                        unknown += rest(at)
                        found.append(name)
                        after = left = last + 1
                        break
                if after:
                    break
        at = after or at + 1
    return found, unknown + rest(len(words))


def identifiers(text: str) -> tuple[list[str], int, int]:
    """Identifiers of a text in order, and the numbers of known and unknown sentences."""
    out, n_known, n_unknown = [], 0, 0
    for paragraph in paragraphs(text):
        if SPDX_TAG.match(paragraph):
            found, known = spdx_identifiers(paragraph)
            out, n_known, n_unknown = out + found, n_known + known, n_unknown + (not known)
            continue
        if not CRITICAL_WORD.search(paragraph.replace("\n", " ")):
            continue
        for sentence in SENTENCE_END.split(paragraph):
            if CRITICAL_WORD.search(sentence.replace("\n", " ")):
                found, unknown = sentence_identifiers(sentence)
                out, n_known, n_unknown = out + found, n_known + len(found), n_unknown + unknown
    return out, n_known, n_unknown


def read_sentences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Identifiers and counts of each text; null texts have none."""
    for batch in batches:
        found = [identifiers(t.as_py()) if t.is_valid else ([], 0, 0)
                 for t in batch.column("text")]
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"),
            "ids": pa.array([f[0] for f in found], pa.list_(pa.string())),
            "n_known": pa.array([f[1] for f in found], pa.int64()),
            "n_unknown": pa.array([f[2] for f in found], pa.int64())})


def marked(identifiers: tuple[str, ...]) -> str:
    return "".join(f"<{i}>" for i in identifiers)


def match_rules(sequence: Column) -> Column:
    """``names`` of the licenses found and the ``rest`` of the sequence; what a rule took out
    leaves a mark, so that its neighbours do not become a sequence."""
    rules = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(marked(s)).alias("ids"))
                      for n, s in ALL_RULES])
    none = F.struct(sequence.alias("rest"), F.array().cast("array<string>").alias("names"))
    return F.aggregate(rules, none, lambda got, rule: F.when(
        F.contains(got["rest"], rule["ids"]), F.struct(
            F.replace(got["rest"], rule["ids"], F.lit("<>")).alias("rest"),
            F.array_append(got["names"], rule["name"]).alias("names"))).otherwise(got))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``doc_id, licenses, n_known, n_unknown, rest`` for each row of ``docs(doc_id, text)``.

    ``licenses`` are the distinct names in the order of the rules, joined by commas;
    ``n_known`` and ``n_unknown`` count the sentences and SPDX tags with a critical word that
    are and are not known; a tag is known if all its names are. ``rest`` has the identifiers that no rule used. Texts without such sentences,
    null and empty ones included, have empty strings and zeros. Rows with equal or null doc_id
    are scanned one by one. Extra columns are ignored; no rows give none.
    """
    text = F.col("text").cast("string")
    result = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("ids", T.ArrayType(T.StringType())),
        T.StructField("n_known", T.LongType()), T.StructField("n_unknown", T.LongType())])
    # Only texts with a critical word go to Python.
    rows = docs.select("doc_id", F.when(F.lower(text).rlike(LIKELY), text).alias("text")
                       ).mapInArrow(read_sentences, result)
    sequence = F.concat_ws("", F.transform("ids", lambda i: F.concat(
        F.lit("<"), i, F.lit(">"))))
    matched = F.when(F.size("ids") > 0, match_rules(sequence))
    return rows.withColumn("matched", matched).select(
        "doc_id",
        F.coalesce(F.concat_ws(",", F.array_distinct("matched.names")), F.lit(""))
        .alias("licenses"), "n_known", "n_unknown",
        F.coalesce(F.replace(F.col("matched.rest"), F.lit("<>"), F.lit("")), F.lit(""))
        .alias("rest"))


def oracle_sql() -> str:
    """The scan of the table ``documents`` in SQL: sentences as rows, a step for each rule."""
    values = ", ".join(f"('{s}', '{i}')" for s, i in SENTENCES.items())
    steps, last = [], "seq"
    for k, (name, ids) in enumerate(RULES):
        steps.append(
            f"r{k} AS (SELECT doc_id, replace(rest, '{marked(ids)}', '<>') AS rest, "
            f"CASE WHEN contains(rest, '{marked(ids)}') THEN list_append(names, '{name}') "
            f"ELSE names END AS names FROM {last})")
        last = f"r{k}"
    return f"""
WITH known(sentence, id) AS (VALUES {values}),
cut AS (
  SELECT doc_id, unnest(string_split(regexp_replace(coalesce(text, ''),
      '([.!?])[ \\t\\n\\r\\f]+', '\\1' || chr(10), 'g'), chr(10))) AS s,
    generate_subscripts(string_split(regexp_replace(coalesce(text, ''),
      '([.!?])[ \\t\\n\\r\\f]+', '\\1' || chr(10), 'g'), chr(10)), 1) AS k
  FROM documents),
plain AS (
  SELECT doc_id, k, regexp_replace(regexp_replace(trim(regexp_replace(lower(s),
      '[^a-z0-9.+-]+', ' ', 'g')), '[ .]+$', ''), '{OPENING}', '') AS sentence
  FROM cut WHERE regexp_matches(lower(s), '{CRITICAL}')),
named AS (SELECT doc_id, k, id FROM plain LEFT JOIN known USING (sentence)),
counted AS (
  SELECT doc_id, count(id) AS n_known, count(*) - count(id) AS n_unknown
  FROM named GROUP BY doc_id),
seq AS (
  SELECT doc_id, string_agg('<' || id || '>', '' ORDER BY k) AS rest, []::VARCHAR[] AS names
  FROM named WHERE id IS NOT NULL GROUP BY doc_id),
{", ".join(steps)}
SELECT d.doc_id, coalesce(array_to_string(list_transform(range(1, len(names) + 1),
    lambda i: CASE WHEN list_position(names, names[i]) = i THEN names[i] END), ','), '')
    AS licenses,
  coalesce(n_known, 0) AS n_known, coalesce(n_unknown, 0) AS n_unknown,
  coalesce(replace(rest, '<>', ''), '') AS rest
FROM documents d LEFT JOIN counted USING (doc_id) LEFT JOIN {last} USING (doc_id)
"""
