"""License scans by diagonal voting.

All rolling word k-grams of all documents are joined, by hash, with the places where the templates hold the same k-gram. A
match votes for its diagonal, the place in the document minus the place in the template. Neighbouring diagonals, which
added or left out words make, are merged, the farther apart the longer the template is; what is left are spans of a document that follow a template. A span counts if
its matched words cover enough of the template and of the span itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import map_batches, sliced
from corpusloom.session import materialize

GRAM = 4
#: diagonals so far apart, or closer, belong to one span: as many words, or such a part of the template's
DIAGONAL_GAP = 3
GAP_PART = 0.25
#: parts of the template and of the span that matched words must cover
MIN_TEMPLATE = 0.6
MIN_SPAN = 0.6
#: words of the template that must match, all of a shorter one
MIN_MATCH = 12
#: template k-grams up to this number are sent to every task
BROADCAST_GRAMS = 100_000
CHUNK_ROWS = 400_000
CACHE_WORDS = 200_000
#: what a phrase alone counts
PHRASE_SCORE = 0.5

# fixed values: phrases and labels
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# fixed values: sections of the texts of public licences, and notices, by label; a section found alone tells the licence too
SECTIONS = {
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
        "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
        "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may "
        "obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions "
        "and limitations under the License.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED "
        "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
        "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
        "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
        "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at",
    ],
    "zlib": [
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute "
        "it freely, subject to the following restrictions",
    ],
    "boost": [
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation "
        "covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative "
        "works of the Software",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0."],
    "cc-by": ["Licensed under CC BY 4.0."],
}

# fixed values: names that stand for a licence wherever they are, and names that do with a version; licences whose notices are those of another
# one but for the name are told by the name alone
NAMES = {
    "gpl": ["GNU General Public License"],
    "lgpl": ["GNU Lesser General Public License", "GNU Library General Public License"],
    "agpl": ["GNU Affero General Public License"],
    "mpl": ["under the Mozilla Public License"],
    "isc": ["under the ISC License"],
    "bsd": ["BSD 2-Clause License", "BSD 3-Clause License", "under the BSD License"],
    "cc0": ["CC0 1.0 Universal"],
}
CC = ["1.0", "2.0", "2.5", "3.0", "4.0"]
VERSIONED = {
    "apache": (["Apache License"], ["1.1", "2.0"]),
    "mpl": (["Mozilla Public License"], ["1.1", "2.0"]),
    "epl": (["Eclipse Public License"], ["1.0", "2.0"]),
    "boost": (["Boost Software License"], ["1.0"]),
    "cc-by": (["CC BY", "Creative Commons Attribution"], CC),
    "cc-by-sa": (["CC BY-SA", "Creative Commons Attribution-ShareAlike"], CC),
    "cc-by-nd": (["CC BY-ND", "Creative Commons Attribution-NoDerivatives"], CC),
    "cc-by-nc": (["CC BY-NC", "Creative Commons Attribution-NonCommercial"], CC),
    "cc-by-nc-sa": (["CC BY-NC-SA", "Creative Commons Attribution-NonCommercial-ShareAlike"], CC),
    "cc-by-nc-nd": (["CC BY-NC-ND", "Creative Commons Attribution-NonCommercial-NoDerivatives"], CC),
}


def dictionary() -> dict[str, list[str]]:
    """All sections, names and versioned names by label."""
    out = {label: list(bodies) for label, bodies in SECTIONS.items()}
    for label, names in NAMES.items():
        out.setdefault(label, []).extend(names)
    for label, (names, versions) in VERSIONED.items():
        joints = ["{} {}"] if label.startswith("cc-") else ["{} {}", "{} v{}", "{} version {}"]
        out.setdefault(label, []).extend(joint.format(name, v) for name in names for v in versions for joint in joints)
    return out


TEMPLATES = dictionary()

# lower case for A-Z, a blank for all that is no word character; bytes from 0x80 on belong to words
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split()


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= 48:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = value
        return value


def gram_hashes(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    """A hash for every ``GRAM`` consecutive words."""
    n = len(words) - GRAM + 1
    if n < 1:
        return np.zeros(0, np.int64)
    one = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    out = np.zeros(n, np.uint64)
    for k in range(GRAM):
        out = out * np.uint64(0x9E3779B97F4A7C15) + one[k : k + n]
    return (out ^ out >> np.uint64(31)).view(np.int64)


def texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The key, the text and a hash of it: rows that share a key are told apart unless their texts are equal too."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(t).alias("text_id"), t.alias("text"))


def grams(rows: DataFrame) -> DataFrame:
    """``doc_id, text_id, at, gram`` for every rolling k-gram of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, names = WordHashes(), ["doc_id", "text_id", "at", "gram"]

        def flush(held: list[tuple]) -> pa.RecordBatch:
            sizes = [len(g) for *_, g in held]
            columns = [pa.array([x[i] for x in held], pa.int64()).take(pa.array(np.repeat(np.arange(len(held)), sizes))) for i in (0, 1)]
            at = np.concatenate([np.arange(lo, lo + n, dtype=np.int32) for (_, _, lo, _), n in zip(held, sizes)])
            return pa.RecordBatch.from_arrays([*columns, pa.array(at), pa.array(np.concatenate([x[3] for x in held]))], names)

        for batch in sliced(batches):
            held, n = [], 0
            for doc, text_id, t in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_id", "text"))):
                found = gram_hashes(words_of(t), hashes)
                for lo in range(0, len(found), CHUNK_ROWS):
                    held.append((doc, text_id, lo, found[lo : lo + CHUNK_ROWS]))
                    n += len(held[-1][3])
                    if n >= CHUNK_ROWS:
                        yield flush(held)
                        held, n = [], 0
            if held:
                yield flush(held)

    return rows.mapInArrow(run, "doc_id long, text_id long, at int, gram long")


def template_grams(spark, templates: dict[str, list[str]]) -> DataFrame:
    hashes, rows, number = WordHashes(), [], 0
    for label, bodies in templates.items():
        for body in bodies:
            found = gram_hashes(words_of(body), hashes).tolist()
            rows += [(number, label, len(found) + GRAM - 1, t, g) for t, g in enumerate(found)]
            number += 1
    df = spark.createDataFrame(rows, "template int, label string, template_words int, t int, gram long")
    return F.broadcast(df) if len(rows) <= BROADCAST_GRAMS else df


def spans(rows: DataFrame, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """``doc_id, text_id, label, template, start, stop, coverage``: verified spans, places in words, ``stop`` exclusive."""
    votes = grams(rows).join(template_grams(rows.sparkSession, templates), "gram")
    votes = votes.select("doc_id", "text_id", "template", "label", "template_words", "at", "t", (F.col("at") - F.col("t")).alias("diagonal"))
    where = ["doc_id", "text_id", "template", "label", "template_words"]
    # the places on a diagonal: at most as many as the template has
    lines = votes.groupBy(*where, "diagonal").agg(F.sort_array(F.collect_set("t")).alias("ts"))
    w = Window.partitionBy(*where).orderBy("diagonal")
    gap = F.greatest(F.lit(float(DIAGONAL_GAP)), GAP_PART * F.col("template_words"))
    new = (F.col("diagonal") - F.lag("diagonal").over(w) <= gap).cast("int")
    lines = lines.withColumn("_new", 1 - F.coalesce(new, F.lit(0)))
    lines = lines.withColumn("cluster", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    steps = lambda c: F.flatten(F.transform(c, lambda x: F.transform(F.array(*[F.lit(i) for i in range(GRAM)]), lambda i: x + i)))
    here = F.transform("ts", lambda t: t + F.col("diagonal"))
    merged = lines.select(*where, "cluster", steps(F.col("ts")).alias("_t"), steps(here).alias("_at"))
    merged = merged.groupBy(*where, "cluster").agg(F.array_distinct(F.flatten(F.collect_list("_t"))).alias("_t"), F.array_distinct(F.flatten(F.collect_list("_at"))).alias("_at"))
    start, stop = F.array_min("_at"), F.array_max("_at") + 1
    enough = F.greatest(MIN_TEMPLATE * F.col("template_words"), F.least(F.col("template_words"), F.lit(MIN_MATCH)))
    found = merged.filter(F.size("_t") >= enough).select(
        "doc_id", "text_id", "label", "template", start.alias("start"), stop.alias("stop"),
        (F.size("_t") / F.col("template_words")).alias("coverage"), (F.size("_at") / (stop - start)).alias("_dense"),
    )
    return found.filter(F.col("_dense") >= MIN_SPAN).drop("_dense")


def phrase_places(words: list[bytes]) -> tuple[list[int], list[str]]:
    """Where a phrase's words stand consecutively, and the labels of those found."""
    if b"license" not in words:
        return [], []
    places, labels = [], []
    for phrase, label in PHRASES.items():
        parts = phrase.encode().split()
        at = -1
        while True:
            try:
                at = words.index(parts[0], at + 1)
            except ValueError:
                break
            if words[at : at + len(parts)] == parts:
                places.append(at)
                labels.append(label)
    return places, sorted(set(labels))


def phrases(rows: DataFrame) -> DataFrame:
    """``doc_id, text_id, n_words`` and the places of the phrases in every text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for t in batch.column("text").to_pylist():
            words = words_of(t)
            places, labels = phrase_places(words)
            out.append((len(words), len(places), min(places, default=None), max(places, default=None), labels))
        columns = list(zip(*out))
        kinds = [pa.int64()] * 4 + [pa.list_(pa.string())]
        arrays = [batch.column("doc_id"), batch.column("text_id")] + [pa.array(c, k) for c, k in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_id", "n_words", "n_base", "first_word", "last_word", "base"])

    return map_batches(rows, run, "doc_id long, text_id long, n_words long, n_base long, first_word long, last_word long, base array<string>")


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """For every row of ``docs``: its words, phrase places, phrase labels, all labels, verified spans and a score from 0 to 1.

    The score is the greatest part of a template that a verified span covers, and ``PHRASE_SCORE`` at least where a
    phrase stands. A null text counts as empty; a null key stays null. Repeated rows come out each. Of two spans none
    hides the other. An empty table gives no rows.
    """
    rows = texts(docs, key, text)
    found = spans(rows, templates).groupBy("doc_id", "text_id").agg(
        F.sort_array(F.collect_list(F.struct("start", "stop", "label", "coverage"))).alias("spans"),
        F.collect_set("label").alias("_labels"),
        F.max("coverage").alias("_score"),
    )
    found = materialize(found, "license-spans").withColumnsRenamed({"doc_id": "_doc", "text_id": "_text"})
    base = phrases(rows)
    on = base["doc_id"].eqNullSafe(found["_doc"]) & (base["text_id"] == found["_text"])
    none = F.array().cast("array<string>")
    score = F.greatest(F.coalesce(F.least("_score", F.lit(1.0)), F.lit(0.0)), F.when(F.col("n_base") > 0, PHRASE_SCORE).otherwise(0.0))
    return base.join(found, on, "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base",
        F.sort_array(F.array_union("base", F.coalesce("_labels", none))).alias("labels"), "spans", score.alias("score"),
    )
