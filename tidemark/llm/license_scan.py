"""Licence scan: the digest of a text in canonical form, joined to the digests of known licences.

Canonical form: A-Z in lower case; copyright lines gone; everything but letters, digits and signs over ASCII parts words;
words that licences spell in two ways take one spelling. Whole texts match or don't; nothing is searched for within a text.

The known licences are the texts in TEXTS, in the forms they are commonly found in; another table of digests can be given instead.

Defined cases: a null or empty text has the digest of the empty form and matches no licence. Repeated rows match each. Texts of any
length are read whole. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches, utf8

#: Spellings that the public licence-matching guidelines treat as one.
EQUIVALENT = {
    "acknowledgment": "acknowledgement", "analogue": "analog", "analyse": "analyze", "artefact": "artifact", "authorisation": "authorization",
    "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled", "catalogue": "catalog", "categorise": "categorize", "centre": "center",
    "favour": "favor", "favourite": "favorite", "fulfil": "fulfill", "initialise": "initialize", "judgment": "judgement", "labelling": "labeling",
    "labour": "labor", "licence": "license", "maximise": "maximize", "modelled": "modeled", "optimise": "optimize", "organisation": "organization",
    "organise": "organize", "practise": "practice", "programme": "program", "realise": "realize", "recognise": "recognize", "signalling": "signaling",
    "utilisation": "utilization", "whilst": "while", "wilful": "willful",
}
#: Folder of whole licence texts, each under its public identifier.
TEXTS = Path(__file__).parent / "licenses"
#: Titles that stand above these texts, or don't; the first is the one in the file.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "MIT-0": ("MIT No Attribution", "MIT No Attribution License"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "0BSD": ("Zero-Clause BSD", "BSD Zero Clause License", "Zero-Clause BSD License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License", "The BSD 2-Clause License", "BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License", "The BSD 3-Clause License", "BSD License"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng license"),
    "BSL-1.0": ("Boost Software License - Version 1.0 - August 17th, 2003",),
}
_NOTICE = re.compile(rb"(?m)^[^a-z0-9\x80-\xff\n(]*(?:copyright[ \t]+(?:\(c\)|\xc2\xa9|[0-9]{4})|\(c\)[ \t]*[0-9]{4}|\xc2\xa9[ \t]*[0-9]{4})[^\n]*$")
_WORD_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_EQUIVALENT = {k.encode(): v.encode() for k, v in EQUIVALENT.items()}


def canonical(text: bytes) -> bytes:
    text = text.lower()
    if b"copyright" in text or b"(c)" in text or b"\xc2\xa9" in text:
        text = _NOTICE.sub(b"", text)
    words = text.translate(_WORD_BYTES).split()
    if not _EQUIVALENT.keys().isdisjoint(words):
        words = [_EQUIVALENT.get(w, w) for w in words]
    return b" ".join(words)


def digest(text: bytes) -> str:
    return hashlib.sha256(canonical(text)).hexdigest()


_PLACEHOLDER = re.compile(r"(?mi)^[^\n]*copyright[^\n]*[\[<{][^\n]*$")
_TERMS_END = re.compile(r"(?is)^.*?END OF TERMS AND CONDITIONS")


def forms(name: str, text: str) -> set[str]:
    """Ways in which a licence's text stands by itself: with one of its titles or none, with the line on all rights, with its
    placeholder for the copyright line filled in, and with or without what follows its terms."""
    titles = TITLES.get(name, ())
    body = text.removeprefix(titles[0]) if titles else text
    bodies = {body, _PLACEHOLDER.sub("", body)}
    bodies |= {m[0] for b in bodies if (m := _TERMS_END.match(b))}
    return {f"{title}\n{rights}\n{b}" for title in ("", *titles) for rights in ("", "All rights reserved.") for b in bodies}


@lru_cache
def known_digests() -> dict[str, str]:
    """Digest to licence of all forms of the texts in TEXTS."""
    return {digest(form.encode()): path.stem for path in sorted(TEXTS.glob("*.txt")) for form in forms(path.stem, path.read_text(encoding="utf-8"))}


def scan(docs: DataFrame, known: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, digest, license_id (null: no known licence). ``known``: digest, license_id,
    one row per digest; by default the built-in list, whose size is fixed."""
    spark = docs.sparkSession
    if known is None:
        known = F.broadcast(spark.createDataFrame(list(known_digests().items()), "digest string, license_id string"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(parts):
        for batch in batches(parts):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([digest(b) for b in utf8(batch.column(1))], pa.string())], names=["doc_id", "digest"])

    digests = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, digest string")
    return digests.join(known, "digest", "left").select("doc_id", "digest", "license_id")
