"""Licence scans: sparse TF-IDF cosine to templates, then inheritance from the nearest directory.

DataFrame functions only. Document frequencies are counted over all texts, for the templates'
terms and for every term of a unit. Weights are whole thousandths, so
results do not depend on the order of sums.

A unit is a line or a window of consecutive lines (a header), or a whole text of any length (a
licence file). A window takes lines until it holds as many words as the longest template; lines
without words are passed over, and a window that begins or ends with a line without a template's
term is left out, as it scores no more without that line.
Only texts with a strong term are opened: a unit that shares nothing but a template's lightest
terms, whose squares sum to less than the squared threshold of its norm, cannot reach the
threshold (Cauchy-Schwarz), so nothing is lost. A full text's heaviest terms are common words, so
there the shared terms of each text are summed up before it is opened. Units meet templates by
equi-joins on terms.

Short notices are templates of every unit; the full texts of licences (``FULL_TEXTS``) only of whole
texts.

A licence file marks its directory. A text without a licence of its own takes that of the
nearest ancestor directory that has one: directories (not texts) are exploded into ancestors,
equi-joined to the marked ones, and the deepest is kept.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, row_key

THRESHOLD = 0.7

# Short notices of well-known public licences, several for one licence.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
)

_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
          "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.")
_AS_IS = ("THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
          "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD_START = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
              "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
            "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
            "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")

# Full texts of licences short enough to stand here.
FULL_TEXTS = (
    ("MIT", f"MIT License Copyright (c) {_GRANT} {_AS_IS}"),
    ("BSD-2-Clause", f"BSD 2-Clause License Copyright (c) All rights reserved. {_BSD_START} {_BSD_END}"),
    ("BSD-3-Clause", f"BSD 3-Clause License Copyright (c) All rights reserved. {_BSD_START} {_BSD_THIRD} {_BSD_END}"),
    ("ISC", "ISC License Copyright (c) Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR "
            "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
            "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
                   "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
)

_SPLIT = r"[^\p{L}\p{N}]+"


def terms(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), _SPLIT), "")


def _terms(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def weights(counts: Mapping[str, int], n: int, vocabulary: list[str]) -> dict[str, int]:
    """Weights in thousandths: 1 + ln((1 + n) / (1 + df))."""
    return {t: 1000 + round(1000 * math.log((1 + n) / (1 + counts.get(t, 0)))) for t in vocabulary}


def strong_terms(vectors: list[dict[str, int]], threshold: float) -> list[str]:
    """Terms of which a unit needs at least one to reach the threshold with any template."""
    out: set[str] = set()
    for vector in vectors:
        room = threshold**2 * sum(x * x for x in vector.values())
        for term, x in sorted(vector.items(), key=lambda p: (p[1], p[0])):
            room -= x * x
            if room <= 0:
                out.add(term)
    return sorted(out)


def own_licences(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, full_texts=FULL_TEXTS) -> DataFrame:
    """``rk, license, score, kind`` of rows ``(rk, text)`` with a unit like a template; score in thousandths."""
    spark = files.sparkSession
    short, templates = len(templates), (*templates, *full_texts)
    tokens = [_terms(text) for _, text in templates]
    vocabulary = sorted({t for ts in tokens for t in ts})
    some_of = lambda ts: F.array(*[F.lit(t) for t in ts])
    listed = some_of(sorted({t for ts in tokens[:short] for t in ts}))
    scratch = Scratch(spark, "licenses-units")
    n = files.count()
    texts = scratch.save(files.select(F.explode(F.array_distinct(terms(F.col("text")))).alias("other")).groupBy("other").agg(F.count("*").alias("df")), "texts")
    counts = {r["other"]: r["df"] for r in texts.where(F.array_contains(some_of(vocabulary), F.col("other"))).collect()}  # at most as many rows as the templates have terms
    weight = weights(counts, n, vocabulary)
    vectors = [{t: ts.count(t) * weight[t] for t in set(ts)} for ts in tokens]
    strong = some_of(strong_terms(vectors[:short], threshold))
    # these tables are as small as the templates
    weighed = F.broadcast(spark.createDataFrame([(t, w) for t, w in weight.items()], "known string, weight long"))
    sides = F.broadcast(spark.createDataFrame([(t, k, x) for k, v in enumerate(vectors) for t, x in v.items()], "shared string, template int, value long"))
    norms = F.broadcast(spark.createDataFrame([(k, name, float(sum(x * x for x in v.values()))) for k, (v, (name, _)) in enumerate(zip(vectors, templates, strict=True))], "of int, license string, square double"))

    words = terms(F.col("text"))
    opened = scratch.save(files.where(F.arrays_overlap(words, strong)), "opened")
    # texts that share enough of a full text's squared weights to reach the threshold
    squares = [(t, k, x * x, threshold**2 * sum(y * y for y in v.values()) - 1) for k, v in enumerate(vectors) if k >= short for t, x in v.items()]
    squares = F.broadcast(spark.createDataFrame(squares, "shared string, template int, square long, need double"))
    met = files.select("rk", F.explode(F.array_intersect(words, some_of(sorted({t for ts in tokens[short:] for t in ts})).cast("array<string>"))).alias("term")).join(squares, F.col("term") == F.col("shared"))
    likely = scratch.save(met.groupBy("rk", "template").agg(F.sum("square").alias("mass"), F.max("need").alias("need")).where("mass >= need").select("rk").distinct(), "likely")
    more = files.join(likely, "rk", "left_semi").join(opened.select("rk"), "rk", "left_anti")
    longest = max(len(ts) for ts in tokens[:short])
    lines = opened.select("rk", F.filter(F.transform(F.split("text", "\n"), terms), lambda ws: F.size(ws) > 0).alias("lines")).where(F.size("lines") > 0)
    lines = scratch.save(lines, "lines")  # cut once; without the table each window would cut its text again
    starts = lines.select("rk", F.posexplode(F.transform(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: F.slice("lines", i + 1, F.lit(longest)))).alias("at", "run"))
    starts = starts.where(F.arrays_overlap(F.col("run")[0], listed))
    within = lambda k: F.aggregate(F.slice("run", F.lit(1), k - 1), F.lit(0), lambda acc, ws: acc + F.size(ws)) < longest
    ends = F.filter(F.sequence(F.lit(1), F.size("run")), lambda k: within(k) & F.arrays_overlap(F.element_at("run", k), listed))
    windows = starts.select("rk", "at", "run", F.explode(ends).alias("k"))
    lines = windows.select("rk", (F.col("at").cast("long") * longest + F.col("k") - 1).alias("unit"), F.flatten(F.slice("run", F.lit(1), F.col("k"))).alias("words"))
    whole = opened.unionByName(more).select("rk", F.lit(-1).cast("long").alias("unit"), words.alias("words"))
    units = lines.where(F.arrays_overlap("words", strong)).union(whole)
    spread = units.select("rk", "unit", F.explode("words").alias("term")).groupBy("rk", "unit", "term").agg(F.count("*").alias("tf"))
    spread = scratch.save(spread, "spread")
    others = spread.select("term").distinct().join(weighed, F.col("term") == F.col("known"), "left_anti")
    rare = texts.join(others, F.col("other") == F.col("term"), "left_semi").select("other", (F.lit(1000) + F.round(1000 * F.log(F.lit(1.0 + n) / (1 + F.col("df"))))).cast("long").alias("counted"))
    rare = scratch.save(rare, "weights")
    spread = spread.join(weighed, F.col("term") == F.col("known"), "left").join(rare, F.col("term") == F.col("other"), "left").select("rk", "unit", "term", (F.col("tf") * F.coalesce("weight", "counted")).alias("x"))
    length = spread.groupBy("rk", "unit").agg(F.sum((F.col("x") * F.col("x"))).cast("double").alias("own"))
    fits = (F.col("term") == F.col("shared")) & ((F.col("template") < short) | (F.col("unit") == -1))
    dots = spread.join(sides, fits).groupBy("rk", "unit", "template").agg(F.sum(F.col("x") * F.col("value")).cast("double").alias("dot"))
    scored = dots.join(length, ["rk", "unit"]).join(norms, F.col("template") == F.col("of"))
    scored = scored.withColumn("score", F.floor(1000 * F.col("dot") / F.sqrt(F.col("own") * F.col("square")) + 1e-9).cast("int")).where(F.col("score") >= int(1000 * threshold))
    best = scored.groupBy("rk").agg(F.max(F.struct("score", (F.col("unit") == -1).alias("file"), (-F.col("template")).alias("order"), "license")).alias("b"),
                                    F.max(F.when(F.col("unit") == -1, F.struct("score", (-F.col("template")).alias("order"), "license"))).alias("f"))
    return best.select("rk", F.coalesce("f.license", "b.license").alias("license"), F.coalesce("f.score", "b.score").alias("score"), F.when(F.col("f").isNotNull(), "file").otherwise("header").alias("kind"))


def scan(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, full_texts=FULL_TEXTS) -> DataFrame:
    """``doc_id, path, license, kind, score, found_in`` for every row of ``files(doc_id, path, text, ...)``.

    ``kind`` is ``file`` (the text is little but a licence), ``header`` (a line or some consecutive lines of it are like one),
    ``inherited`` (from the licence file of the nearest directory upwards) or null; ``found_in`` is
    the directory the licence holds for, or the path itself for a header. Null and empty texts
    have no licence of their own; a null path has no directory; of several licence files of a
    directory the best score counts, then the first name; equal rows are judged alike; further
    columns are ignored; no rows give no rows.
    """
    scratch = Scratch(files.sparkSession, "licenses")
    narrow = files.select("doc_id", F.col("path").cast("string").alias("path"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    narrow = narrow.withColumn("rk", row_key("doc_id", "path", "text"))
    # the directory with its slash at the end: "" is the root
    places = narrow.select("doc_id", "path", "rk", F.regexp_extract(F.coalesce("path", F.lit("")), "^(.*/)?", 0).alias("dir"))
    own = scratch.save(own_licences(narrow.select("rk", "text"), templates, threshold, full_texts), "own")
    marked = places.where("path is not null").join(own.where("kind = 'file'"), "rk").groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("m"))
    marked = scratch.save(marked.select(F.col("dir").alias("at"), F.col("m.license").alias("lent"), (-F.col("m.s")).alias("lent_score")), "marked")
    dirs = places.where("path is not null").select("dir").distinct()
    steps = F.split("dir", "(?<=/)")
    above = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(steps)), lambda k: F.array_join(F.slice(steps, F.lit(1), k), ""))).alias("up")).distinct()
    nearest = above.join(marked, F.col("up") == F.col("at")).groupBy("dir").agg(F.max(F.struct(F.length("up").alias("n"), "up", "lent", "lent_score")).alias("near"))
    nearest = scratch.save(nearest.select(F.col("dir").alias("in_dir"), "near.up", "near.lent", "near.lent_score"), "nearest")
    own = own.withColumnRenamed("rk", "own_rk")
    out = places.join(own, F.col("rk") == F.col("own_rk"), "left").join(nearest, F.col("path").isNotNull() & (F.col("dir") == F.col("in_dir")), "left")
    found = F.when(F.col("kind") == "file", F.col("dir")).when(F.col("kind") == "header", F.col("path")).otherwise(F.col("up"))
    kind = F.coalesce("kind", F.when(F.col("lent").isNotNull(), F.lit("inherited")))
    return out.select("doc_id", "path", F.coalesce("license", "lent").alias("license"), kind.alias("kind"), F.coalesce("score", "lent_score").alias("score"), found.alias("found_in"))
