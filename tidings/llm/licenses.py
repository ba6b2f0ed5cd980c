"""License scans: positional rare-token index over licence notices.

Rarity is the inverse document frequency of the templates' words over all
documents: one pass counts, in how many documents each template word occurs
(the count table has a row for each template word at most). Of each template,
the words with the highest IDF are indexed as postings (template, position):
the words that an alignment may miss, one more, and a fifth of the template more. An alignment
with the wanted share then has at least that fifth and one of them in place, so none is overlooked,
however long the file and however many notices it holds. Each place such a word stands at
votes, through each posting, for a relative position of a template. An
alignment with votes enough is compared word by word, and counts only if the
template's mandatory key phrases stand there too.

Base: places where a fixed phrase's words stand consecutively.

Ties: words of equal IDF are taken in the order of the words, then of their positions; the result does not depend
on it. Votes are counted over `SPAN` positions at a time, so a very long text takes linear time and little memory.

Defined cases: null text counts as empty; a text without words or licence has
zero counts, null positions, empty labels and score 0. Texts of any length are
read whole. Repeated rows get equal results, null ids are carried along; other
columns, whatever their names, are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import bisect
import math
from collections import Counter, defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import text_udf, whole_text
from tidings.session import ship_package

# Phrases of the base and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Usual notices, headers and licence texts (label, words, mandatory key phrases).
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
            "software and associated documentation files", ("permission is hereby granted free of charge",)),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("gpl-2.0", "this file is licensed under the gnu general public license version 2",
     ("gnu general public license version 2",)),
    ("gpl-3.0", "this file is licensed under the gnu general public license version 3",
     ("gnu general public license version 3",)),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public "
            "license as published by the free software foundation", ("gnu general public license",)),
    ("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
            "permitted provided that the following conditions are met",
     ("redistribution and use in source and binary forms",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ("mozilla public license",)),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights",
     ("waived all copyright and related",)),
    ("proprietary", "all rights reserved", ("all rights reserved",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction including "
            "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies "
            "of the software and to permit persons to whom the software is furnished to do so subject to the "
            "following conditions the above copyright notice and this permission notice shall be included in all "
            "copies or substantial portions of the software the software is provided as is without warranty of any "
            "kind express or implied including but not limited to the warranties of merchantability fitness for a "
            "particular purpose and noninfringement in no event shall the authors or copyright holders be liable "
            "for any claim damages or other liability whether in an action of contract tort or otherwise arising "
            "from out of or in connection with the software or the use or other dealings in the software",
     ("permission is hereby granted free of charge", "shall the authors or copyright holders be liable")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted provided that the above copyright notice and this permission notice appear in all copies "
            "the software is provided as is and the author disclaims all warranties with regard to this software "
            "including all implied warranties of merchantability and fitness in no event shall the author be liable "
            "for any special direct indirect or consequential damages or any damages whatsoever resulting from loss "
            "of use data or profits whether in an action of contract negligence or other tortious action arising "
            "out of or in connection with the use or performance of this software",
     ("with or without fee is hereby granted provided that",)),
    ("0bsd", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
             "hereby granted the software is provided as is and the author disclaims all warranties",
     ("with or without fee is hereby granted the software",)),
    ("bsd-2-clause", "redistributions of source code must retain the above copyright notice this list of conditions "
                     "and the following disclaimer 2 redistributions in binary form must reproduce the above "
                     "copyright notice this list of conditions and the following disclaimer in the documentation and "
                     "or other materials provided with the distribution",
     ("redistributions in binary form must reproduce",)),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to "
                     "endorse or promote products derived from this software without specific prior written permission",
     ("endorse or promote products derived from this software",)),
    ("bsd", "this software is provided by the copyright holders and contributors as is and any express or implied "
            "warranties including but not limited to the implied warranties of merchantability and fitness for a "
            "particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for "
            "any direct indirect incidental special exemplary or consequential damages including but not limited to "
            "procurement of substitute goods or services loss of use data or profits or business interruption however "
            "caused and on any theory of liability whether in contract strict liability or tort including negligence "
            "or otherwise arising in any way out of the use of this software even if advised of the possibility of "
            "such damage", ("procurement of substitute goods or services",)),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in "
                   "compliance with the license you may obtain a copy of the license at http www apache org licenses "
                   "license 2 0 unless required by applicable law or agreed to in writing software distributed under "
                   "the license is distributed on an as is basis without warranties or conditions of any kind either "
                   "express or implied see the license for the specific language governing permissions and "
                   "limitations under the license", ("apache license version 2 0", "except in compliance with")),
    ("apache-2.0", "licensed to the apache software foundation asf under one or more contributor license agreements "
                   "see the notice file distributed with this work for additional information regarding copyright "
                   "ownership the asf licenses this file to you under the apache license version 2 0",
     ("contributor license agreements",)),
    ("gpl-2.0-or-later", "this program is free software you can redistribute it and or modify it under the terms of "
                         "the gnu general public license as published by the free software foundation either version 2 "
                         "of the license or at your option any later version this program is distributed in the hope "
                         "that it will be useful but without any warranty without even the implied warranty of "
                         "merchantability or fitness for a particular purpose see the gnu general public license for "
                         "more details", ("gnu general public license", "either version 2 of the license")),
    ("gpl-3.0-or-later", "this program is free software you can redistribute it and or modify it under the terms of "
                         "the gnu general public license as published by the free software foundation either version 3 "
                         "of the license or at your option any later version this program is distributed in the hope "
                         "that it will be useful but without any warranty without even the implied warranty of "
                         "merchantability or fitness for a particular purpose see the gnu general public license for "
                         "more details", ("gnu general public license", "either version 3 of the license")),
    ("lgpl-2.1-or-later", "this library is free software you can redistribute it and or modify it under the terms of "
                          "the gnu lesser general public license as published by the free software foundation either "
                          "version 2 1 of the license or at your option any later version",
     ("gnu lesser general public license", "version 2 1 of the license")),
    ("agpl-3.0-or-later", "this program is free software you can redistribute it and or modify it under the terms of "
                          "the gnu affero general public license as published by the free software foundation either "
                          "version 3 of the license or at your option any later version",
     ("gnu affero general public license",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the "
                "mpl was not distributed with this file you can obtain one at", ("mozilla public license v 2 0",)),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse "
                "public license 2 0 which is available at", ("eclipse public license 2 0",)),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the "
                "software and accompanying documentation covered by this license the software to use reproduce "
                "display distribute execute and transmit the software and to prepare derivative works of the software "
                "and to permit third parties to whom the software is furnished to do so",
     ("use reproduce display distribute execute and transmit",)),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be "
             "held liable for any damages arising from the use of this software permission is granted to anyone to use "
             "this software for any purpose including commercial applications and to alter it and redistribute it "
             "freely subject to the following restrictions 1 the origin of this software must not be misrepresented "
             "you must not claim that you wrote the original software if you use this software in a product an "
             "acknowledgment in the product documentation would be appreciated but is not required 2 altered source "
             "versions must be plainly marked as such and must not be misrepresented as being the original software "
             "3 this notice may not be removed or altered from any source distribution",
     ("the origin of this software must not be misrepresented",)),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy "
                  "modify publish use compile sell or distribute this software either in source code form or as a "
                  "compiled binary for any purpose commercial or non commercial and by any means",
     ("free and unencumbered software",)),
    ("cc0", "to the extent possible under law the author has dedicated all copyright and related and neighboring "
            "rights to this software to the public domain worldwide this software is distributed without any warranty",
     ("dedicated all copyright and related",)),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license",
     ("creative commons attribution 4 0",)),
    ("cc-by-sa-4.0", "this work is licensed under a creative commons attribution sharealike 4 0 international license",
     ("creative commons attribution sharealike 4 0",)),
    ("cc-by-nc-4.0", "this work is licensed under a creative commons attribution noncommercial 4 0 international "
                     "license", ("creative commons attribution noncommercial 4 0",)),
)

MIN_SHARE = 0.7        # of a template's words that must stand at their places
SPARE = 5              # one in so many of a template's words is indexed beyond need, to ask for more votes
SPAN = 20_000          # positions whose votes are counted at once

# Bytes that separate words become spaces, A-Z become a-z.
_TO_WORDS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else 0x20 if c <= 0x2F or 0x3A <= c <= 0x60 or 0x7B <= c <= 0x7F else c
    for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split(b" ")


def compact(text: str) -> list[bytes]:
    return [w for w in words_of(text) if w]


class Index:
    """Templates as words, the postings of their rarest words and key phrases."""

    def __init__(self):
        self.templates = [(label, compact(t), [compact(k) for k in keys]) for label, t, keys in TEMPLATES]
        self.vocabulary = frozenset(w for _, words, _ in self.templates for w in words)
        self.phrases = [(_flat(compact(p)), label) for p, label in PHRASES]
        self.missed = [max(m for m in range(len(words)) if (len(words) - m) / len(words) >= MIN_SHARE)
                       for _, words, _ in self.templates]
        self.votes = [1 + len(words) // SPARE for _, words, _ in self.templates]
        self.longest = max(len(words) for _, words, _ in self.templates)
        self._rare: tuple[dict | None, dict] = (None, {})

    def rare_postings(self, idf: dict[bytes, float]) -> dict[bytes, list[tuple[int, int]]]:
        """word -> (template, position) of each template's highest-IDF words: as many as an
        alignment with ``MIN_SHARE`` may miss, and the votes it needs. Kept for the next call with ``idf``."""
        if self._rare[0] is not idf:
            postings = defaultdict(list)
            for t, (_, words, _) in enumerate(self.templates):
                by_idf = sorted(range(len(words)), key=lambda at: (-idf.get(words[at], 0.0), words[at], at))
                for at in by_idf[:self.missed[t] + self.votes[t]]:
                    postings[words[at]].append((t, at))
            self._rare = (idf, dict(postings))
        return self._rare[1]


def _flat(words: list[bytes]) -> bytes:
    return b" " + b" ".join(words) + b" "


def _stands(words: list[bytes], phrase: list[bytes], lo: int, hi: int) -> bool:
    return any(words[i:i + len(phrase)] == phrase for i in range(max(0, lo), hi - len(phrase) + 1))


def base_places(words: list[bytes], index: Index) -> list[tuple[int, str]]:
    """(first word, label) of every place of a base phrase."""
    flat, out = _flat(words), []
    for phrase, label in index.phrases:
        at, word, counted = flat.find(phrase), 0, 0
        while at >= 0:
            # words are counted on from the last place
            word, counted = word + flat.count(b" ", counted, at), at
            out.append((word, label))
            at = flat.find(phrase, at + 1)
    return out


def alignments(words: list[bytes], index: Index, idf: dict[bytes, float]):
    """(template, position of its first word) of every alignment with votes enough."""
    rare = index.rare_postings(idf)
    hits = [at for at, w in enumerate(words) if w in rare]
    for lo in range(-index.longest, len(words), SPAN):
        hi, votes = lo + SPAN, Counter()
        first = bisect.bisect_left(hits, lo)
        for at in hits[first:bisect.bisect_left(hits, hi + index.longest)]:
            votes.update((t, at - place) for t, place in rare[words[at]] if lo <= at - place < hi)
        yield from (where for where, n in votes.items() if n >= index.votes[where[0]])


def matches(words: list[bytes], index: Index, idf: dict[bytes, float]) -> dict[str, float]:
    """label -> best share of a template's words found in place. The postings of the rare words
    that the file has give the alignments; only a full enough one is asked for its key phrases."""
    best: dict[str, float] = {}
    for t, shift in alignments(words, index, idf):
        label, template, keys = index.templates[t]
        if best.get(label, 0.0) == 1.0:
            continue
        share = sum(0 <= shift + i < len(words) and words[shift + i] == w
                    for i, w in enumerate(template)) / len(template)
        if share < MIN_SHARE or share <= best.get(label, 0.0):
            continue
        lo, hi = shift - 2, min(len(words), shift + len(template) + 2)
        if all(_stands(words, k, lo, hi) for k in keys):
            best[label] = share
    return best


def template_idf(docs: DataFrame) -> dict[bytes, float]:
    """IDF of the template words over all documents."""
    ship_package(docs.sparkSession)
    index = Index()

    def run(batches):
        seen, n = Counter(), 0
        for b in batches:
            for text in b["text"].tolist():
                seen.update(index.vocabulary.intersection(words_of(text)))
                n += 1
        yield pd.DataFrame({"word": [w.decode() for w in seen] + [""], "n": [*seen.values(), n]})

    part = docs.select(whole_text().alias("text")).mapInPandas(run, "word string, n long")
    counts = {r["word"].encode(): r["n"] for r in part.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    total = counts.pop(b"", 0)
    return {w: math.log((1 + total) / (1 + counts.get(w, 0))) for w in index.vocabulary}


def find_licenses(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score (1 with a base phrase, else the best alignment's share)."""
    idf = template_idf(docs)

    def make():
        index = Index()

        def step(texts):
            rows = []
            for text in texts:
                words = compact(text)
                places = base_places(words, index)
                own = {label for _, label in places}
                more = matches(words, index, idf)
                at = [a for a, _ in places]
                rows.append((len(words), len(at), min(at) if at else None, max(at) if at else None,
                             ",".join(sorted(own)), ",".join(sorted(own | set(more))),
                             1.0 if at else max(more.values(), default=0.0)))
            cols = list(zip(*rows)) if rows else [()] * 7
            kinds = ("Int64", "Int64", "Int64", "Int64", "object", "object", "float64")
            names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
            return {n: pd.array(list(c), dtype=k) if k == "Int64" else pd.Series(list(c), dtype=k)
                    for n, c, k in zip(names, cols, kinds)}
        return step

    found = text_udf(docs, make, "struct<n_words:long,n_base:long,first_word:long,last_word:long,"
                                 "base_labels:string,labels:string,score:double>")
    return (docs.select("doc_id", whole_text().alias("text"))
            .select("doc_id", found.alias("found")).select("doc_id", "found.*"))
