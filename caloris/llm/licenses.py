"""License scans by patience alignment.

A template and a stretch of text are aligned by the words that occur once in each: the longest increasing subsequence of these
anchors is kept, and the gaps between anchors are aligned in the same way, after equal words at both ends of a gap are taken.
Coverage is the share of the template's words that are aligned; a license is found where it reaches the template's threshold.

Stretches: a short notice is looked for around each place of its rarest words, and must stand there whole. A longer template is
first aligned with the whole text, by anchors unique in both, so that any number of words may stand between its parts; what is left
before and behind a find is searched again. Where a text holds a license several times no word is unique: then stretches around each
place of its rarest words are aligned, then the parts of the text from one place of such a word to the next. A template is passed
over only if a text lacks so many of its words that no alignment could reach the threshold. Overlapping finds keep the one with most
aligned words.

Defined results: a null or empty text has no licenses, coverage 0 and a null best license. Words are compared in lower case (A-Z)
without punctuation; whole texts are read. Rows are independent, so repeated rows give repeated results and an empty table an
empty one. Other columns are never read unless kept.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts

WORDS = re.compile(rb"[a-z0-9\x80-\xff]+(?:\.[0-9]+)*")

_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
    "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
    "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, "
    "BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED "
    "AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
    "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES "
    "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
    "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)

# Texts and notices of public licenses, as their stewards publish them.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "Apache-2.0-copyright-grant": (
        "Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, "
        "worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly "
        "display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form."
    ),
    "Apache-2.0-patent-grant": (
        "Grant of Patent License. Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, "
        "worldwide, non-exclusive, no-charge, royalty-free, irrevocable (except as stated in this section) patent license to make, have made, "
        "use, offer to sell, sell, import, and otherwise transfer the Work, where such license applies only to those patent claims licensable by "
        "such Contributor that are necessarily infringed by their Contribution(s) alone or by combination of their Contribution(s) with the Work "
        "to which such Contribution(s) was submitted."
    ),
    "GPL-3.0-preamble": (
        "The GNU General Public License is a free, copyleft license for software and other kinds of works. The licenses for most software and "
        "other practical works are designed to take away your freedom to share and change the works. By contrast, the GNU General Public License "
        "is intended to guarantee your freedom to share and change all versions of a program--to make sure it remains free software for all its users."
    ),
    "GPL-2.0-preamble": (
        "The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU General Public "
        "License is intended to guarantee your freedom to share and change free software--to make sure the software is free for all its users."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be "
        "misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the "
        "product documentation would be appreciated but is not required. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. This notice may not be removed or altered from any source distribution."
    ),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-text": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You "
        "may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-text": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in "
        "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "LGPL-text": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."
    ),
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."
    ),
    "MPL-2.0-text": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies."
    ),
    "Unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-text": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "All-rights-reserved": "All rights reserved.",
}


# Whole texts are a notice and what follows it.
TEMPLATES |= {
    "MIT-full": f"{TEMPLATES['MIT-text']} {_AS_IS}",
    "BSD-2-Clause": f"{TEMPLATES['BSD-text']} {_BSD_AS_IS}",
    "BSD-3-Clause": (
        f"{TEMPLATES['BSD-text']} Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        f"products derived from this software without specific prior written permission. {_BSD_AS_IS}"
    ),
    "ISC-full": f"{TEMPLATES['ISC-text']} {_ISC_AS_IS}",
    "0BSD": f"{TEMPLATES['ISC-text'].split(', provided')[0]}. {_ISC_AS_IS}",
}

# Further wordings of notices, each of which stands for the license whole.
WORDINGS = {
    "MIT": ("Licensed under the MIT License", "MIT licensed", "The MIT License", "under the terms of the MIT license", "SPDX-License-Identifier: MIT"),
    "Apache-2.0": ("Apache License 2.0", "Apache License, Version 2.0", "Apache 2.0 License", "SPDX-License-Identifier: Apache-2.0"),
    "GPL-3.0": ("GPLv3", "GNU GPL v3", "GNU General Public License v3.0", "GNU General Public License, version 3", "SPDX-License-Identifier: GPL-3.0"),
    "GPL-2.0": ("GPLv2", "GNU GPL v2", "GNU General Public License v2.0", "GNU General Public License, version 2", "SPDX-License-Identifier: GPL-2.0"),
    "LGPL-2.1": ("LGPLv2.1", "GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1"),
    "LGPL-3.0": ("LGPLv3", "GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0"),
    "AGPL-3.0": ("AGPLv3", "GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-clause BSD license", "SPDX-License-Identifier: BSD-3-Clause"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-clause BSD license", "SPDX-License-Identifier: BSD-2-Clause"),
    "MPL-2.0": ("Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "Mozilla Public License, version 2.0"),
    "CC-BY-4.0": ("Creative Commons Attribution 4.0",),
    "CC-BY-SA-4.0": ("Creative Commons Attribution-ShareAlike 4.0",),
    "CC-BY-NC-4.0": ("Creative Commons Attribution-NonCommercial 4.0",),
    "CC0-1.0": ("CC0 1.0 Universal",),
}


def words_of(raw: bytes) -> list[bytes]:
    return WORDS.findall(raw)


def longest_increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of pairs, sorted by their first numbers, whose second numbers increase."""
    tops: list[int] = []
    top_at: list[int] = []
    before = [-1] * len(pairs)
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(tops, b)
        before[i] = top_at[k - 1] if k else -1
        tops[k : k + 1], top_at[k : k + 1] = [b], [i]
    out, i = [], top_at[-1] if top_at else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def patience(a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Places of aligned words in a and b, both increasing."""
    out = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i == m or j == n:
            continue
        in_a, in_b = Counter(a[i:m]), Counter(b[j:n])
        at_b = {w: k for k, w in enumerate(b[j:n], j) if in_b[w] == 1}
        anchors = longest_increasing([(k, at_b[w]) for k, w in enumerate(a[i:m], i) if in_a[w] == 1 and w in at_b])
        if not anchors:
            continue
        out += anchors
        ends = [(i - 1, j - 1), *anchors, (m, n)]
        todo += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(ends, ends[1:])]
    return sorted(out)


#: Templates of fewer words must stand whole and nearly together.
SHORT = 20


@dataclass(frozen=True)
class Template:
    name: str
    words: list[bytes]
    need: int
    keys: dict[bytes, list[int]]  # places of its rarest words

    @property
    def slack(self) -> int:
        return max(3, len(self.words) // 3)

    @cached_property
    def vocabulary(self) -> frozenset[bytes]:
        return frozenset(self.words)

    @cached_property
    def least_distinct(self) -> int:
        """The fewest distinct words that `need` places can have."""
        left, n = self.need, 0
        for _, times in Counter(self.words).most_common():
            left, n = left - times, n + 1
            if left <= 0:
                break
        return n


def templates(texts: dict[str, str] | None = None, least: float = 0.8, wordings: dict[str, tuple[str, ...]] | None = None) -> list[Template]:
    """Short templates must match whole: a word more or less would make another license of them."""
    if texts is None:
        texts, wordings = TEMPLATES, WORDINGS
    named = [*texts.items(), *((k, w) for k, some in (wordings or {}).items() for w in some)]
    split = [(k, words_of(v.encode().lower())) for k, v in named]
    used = Counter(w for _, words in split for w in set(words))
    common = Counter(w for _, words in split for w in words)
    out = []
    for name, words in split:
        need = len(words) if len(words) < SHORT else -int(-least * len(words) // 1)
        # of any set of more places than may be missing, one is aligned: the rarest words' places make the set
        order = sorted(range(len(words)), key=lambda i: (used[words[i]] + common[words[i]], -len(words[i]), i))
        keys: dict[bytes, list[int]] = {}
        for i in order[: len(words) - need + 1]:
            keys.setdefault(words[i], [])
        for i, w in enumerate(words):
            if w in keys:
                keys[w].append(i)
        out.append(Template(name, words, need, keys))
    return out


def _aligned(t: Template, words: list[bytes], places: list[int]) -> list[int]:
    """The places, out of `places`, of the template's words in the text, if they are enough."""
    if len(places) < t.need:
        return []
    found = [places[j] for _, j in patience(t.words, [words[i] for i in places])]
    return found if len(found) >= t.need else []


def _around(t: Template, words: list[bytes], places: list[int]) -> list[list[int]]:
    """Finds in stretches around each place of the rarest words."""
    out, done = [], -1
    for at in places:
        if at <= done:
            continue
        for place in t.keys.get(words[at], ()):
            begin = max(done + 1, at - place - t.slack)
            some = places[bisect_left(places, begin) : bisect_left(places, at - place + len(t.words) + t.slack)]
            if found := _aligned(t, words, some):
                out.append(found)
                done = found[-1]
                break
    return out


def _between(t: Template, words: list[bytes], places: list[int]) -> list[int]:
    """A find in the part of the text from one place of a rare word to the next."""
    for key in sorted(t.keys, key=lambda k: t.keys[k][0]):
        at = [i for i in places if words[i] == key]
        if len(at) < 2:
            continue
        begins = [bisect_left(places, i - t.keys[key][0] - t.slack) for i in at]
        for a, b in zip(begins, [*begins[1:], len(places)], strict=True):
            if found := _aligned(t, words, places[a:b]):
                return found
    return []


def _finds(t: Template, words: list[bytes], places: list[int]) -> list[list[int]]:
    """All finds of a template; places: where its words stand in the text."""
    if len(t.words) < SHORT:
        return _around(t, words, places)
    out, todo = [], [places]
    while todo:
        some = todo.pop()
        if len(some) < t.need:
            continue
        found = _aligned(t, words, some)
        several = [found] if found else _around(t, words, some) or [x for x in [_between(t, words, some)] if x]
        if not several:
            continue
        out += several
        ends = [-1, *(bisect_left(some, k) for f in several for k in (f[0], f[-1])), len(some)]
        todo += [some[a + 1 : b] for a, b in zip(ends[0::2], ends[1::2], strict=True)]
    return out


def find(words: list[bytes], known: list[Template]) -> list[tuple[int, int, str, int, float]]:
    """(first word, last word, license, aligned words, coverage) of each find, by place."""
    at: dict[bytes, list[int]] = {}
    for i, w in enumerate(words):
        at.setdefault(w, []).append(i)
    found = []
    for t in known:
        if t.keys.keys().isdisjoint(at):
            continue
        shared = [w for w in t.vocabulary if w in at]
        if len(shared) < t.least_distinct:
            continue
        places = sorted(chain.from_iterable(at[w] for w in shared))
        found += [(f[0], f[-1], t.name, len(f), len(f) / len(t.words)) for f in _finds(t, words, places)]
    found.sort(key=lambda x: (-x[3], -x[4], x[0], x[2]))
    kept: list[tuple[int, int, str, int, float]] = []
    for x in found:
        if all(x[1] < k[0] or k[1] < x[0] for k in kept):
            kept.append(x)
    return sorted(kept)


FOUND = T.ArrayType(T.StructType([T.StructField("license", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("aligned", T.IntegerType()), T.StructField("coverage", T.DoubleType())]))


def scan(df: DataFrame, texts: dict[str, str] | None = None, least: float = 0.8, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns, then licenses: an array of (license, start, end, aligned, coverage) in code points, by start."""
    known = templates(texts, least)

    def start():
        every = set().union(*(t.keys for t in known))

        def rows(given):
            out = []
            for text in given:
                raw = (text or "").encode("utf-8", "surrogatepass").lower()
                words = words_of(raw)
                if every.isdisjoint(words):
                    out.append([])
                    continue
                hits = find(words, known)
                spans = [m.span() for m in WORDS.finditer(raw)] if hits else []
                place = lambda k: len(raw[:k].decode("utf-8", "surrogatepass"))  # noqa: B023, E731
                out.append([{"license": name, "start": place(spans[a][0]), "end": place(spans[b][1]), "aligned": n, "coverage": share} for a, b, name, n, share in hits])
            return (out,)

        return rows

    return map_texts(df, df.columns if keep is None else keep, text_col, start, [T.StructField("licenses", FOUND)])


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, number of licenses, all of them as name:start:end, the best one and its coverage."""
    found = scan(df, text_col=text_col, keep=[id_col])
    best = F.array_max(F.transform("licenses", lambda x: F.struct(x["aligned"].alias("aligned"), x["coverage"].alias("coverage"), x["license"].alias("license"))))
    joined = F.array_join(F.transform("licenses", lambda x: F.concat_ws(":", x["license"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    return found.select(id_col, F.size("licenses").cast("long").alias("n_licenses"), joined.alias("spans"), best["license"].alias("best_license"), F.coalesce(best["coverage"], F.lit(0.0)).alias("best_coverage"))
