"""Licence scans in DataFrame functions only: Dice coefficient of word bigrams against templates.

A text is normalised once (lower case, words of a-z and 0-9), and the places of bigrams that occur in a
template are kept. Any stretch of the text may hold a licence: in a longer line, wrapped over lines or
in several paragraphs. A stretch's coefficient with a template is 2 s / (s + o + n): s distinct
bigrams of the template in it, o other bigrams, n distinct bigrams of the template. `MIN_DICE` bounds
the size of a matching stretch to between d / (2 - d) and (2 - d) / d times n, and s to at least
d / (2 - d) times n: a template stays a candidate for a text only if the text shares that many
bigrams with it, and stretches run from one shared bigram to another within the size bound. Both prunings
lose nothing. Candidates' places become rows, so that the place before of the same bigram comes from one sort, and each
place starts stretches of no more places than the size bound: work grows with a text's shared bigrams, not with their powers.

Cases: null and empty texts match nothing; a text of one word has no bigram; ties of templates are
all reported, as are templates that differ in a few words; of equal stretches the first counts; repeated
rows are reported each; extra columns of docs are left out whatever their names; an empty table gives an
empty result; texts are read whole.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame, Window, functions as F

from admill.llm.common import require

MIN_DICE = 0.82

#: Notices that licences ask for or that are licences themselves, by SPDX name where there is one.
TEMPLATES = {
    "Apache-2.0/short": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0/header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "MIT/short": "Released under the MIT License.",
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "GPL-3.0/short": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0/short": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0/short": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0/short": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0/header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "ISC": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.',
    "BSD/clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "BSD/short": "Licensed under the BSD License.",
    "CC-BY-4.0/short": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0/short": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0/short": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0/short": "Licensed under CC BY-ND 4.0.",
    "CC-BY-4.0/long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0/short": "To the extent possible under law, the author has dedicated all copyright to the public domain worldwide.",
    "All-rights-reserved": "All rights reserved.",
    "BSD-2-Clause": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "BSD-3-Clause/third": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "ISC/full": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "GPL-2.0-or-later/header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "GPL-3.0-or-later/header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "LGPL-2.1-or-later/header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    "AGPL-3.0-or-later/header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
    "BSL-1.0/header": "Distributed under the Boost Software License, Version 1.0.",
    "GPL-3.0/name": "GNU General Public License v3.0",
    "GPL-2.0/name": "GNU General Public License v2.0",
    "LGPL-3.0/name": "GNU Lesser General Public License v3.0",
    "AGPL-3.0/name": "GNU Affero General Public License v3.0",
    "SPDX/MIT": "SPDX-License-Identifier: MIT",
    "SPDX/Apache-2.0": "SPDX-License-Identifier: Apache-2.0",
    "SPDX/BSD-3-Clause": "SPDX-License-Identifier: BSD-3-Clause",
    "SPDX/GPL-2.0": "SPDX-License-Identifier: GPL-2.0",
    "SPDX/GPL-3.0": "SPDX-License-Identifier: GPL-3.0",
    "SPDX/MPL-2.0": "SPDX-License-Identifier: MPL-2.0",
}


def bigrams(text: str) -> set[str]:
    words = re.findall("[a-z0-9]+", text.lower())
    return {f"{a} {b}" for a, b in zip(words, words[1:])}


def text_words(text: Column) -> Column:
    """Words of a text; the first and last may be empty."""
    return F.split(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "), " ")


def shared_places(words: Column, every: list[str]) -> Column:
    """Array of (at, gram) for the places of the given bigrams among the words."""
    grams = F.zip_with(words, F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.filter(F.transform(grams, lambda g, i: F.struct(i.alias("at"), g.alias("gram"))), lambda x: x["gram"].isin(every))


def best_stretch(places: Column, n: Column, widest: Column) -> Column:
    """(dice, -first word) of the best stretch that starts and ends at one of a template's places (at, before: the place before of the same bigram)."""

    def step(start: Column):
        def add(acc: Column, y: Column) -> Column:
            inside = y["at"] - start["at"] < widest
            s = acc["s"] + F.when(F.coalesce(y["before"], F.lit(-1)) < start["at"], 1).otherwise(0)
            h = acc["h"] + 1
            other = y["at"] - start["at"] + 1 - h
            dice = F.lit(2.0) * s / (s + other + n)
            return F.struct(s.alias("s"), h.alias("h"), F.when(inside, F.greatest(acc["dice"], dice)).otherwise(acc["dice"]).alias("dice"))

        return add

    zero = F.struct(F.lit(0).alias("s"), F.lit(0).alias("h"), F.lit(0.0).alias("dice"))
    each = F.transform(places, lambda x, i: F.struct(F.aggregate(F.slice(places, i + 1, widest), zero, step(x), lambda acc: acc["dice"]).alias("dice"), (-x["at"]).alias("first")))
    return F.array_max(each)


def license_matches(docs: DataFrame, templates: dict[str, str] = TEMPLATES, min_dice: float = MIN_DICE) -> DataFrame:
    """(_row, doc_id, license, dice, first_word) for each licence found in a row of docs: its best stretch."""
    share = min_dice / (2 - min_dice)
    known = [{"license": k, "n": len(g), "least": math.ceil(share * len(g)), "widest": int(len(g) / share), "grams": sorted(g)} for k, v in templates.items() if (g := bigrams(v))]
    table = F.from_json(F.lit(json.dumps(known)), "array<struct<license: string, n: int, least: int, widest: int, grams: array<string>>>")
    every = sorted({g for t in known for g in t["grams"]})
    fewest = min(t["least"] for t in known)

    rows = require(docs, "doc_id", "text").select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text").filter(F.col("text").isNotNull())
    found = rows.withColumn("_words", text_words(F.col("text"))).select("_row", "doc_id", shared_places(F.col("_words"), every).alias("_at"))
    found = found.withColumn("_grams", F.array_distinct(F.transform("_at", lambda x: x["gram"]))).filter(F.size("_grams") >= fewest)
    fits = lambda t: (F.size("_grams") >= t["least"]) & (F.size(F.array_intersect("_grams", t["grams"])) >= t["least"])
    candidates = found.withColumn("t", F.explode(F.filter(table, fits)))
    shown = F.filter("_at", lambda x: F.array_contains("t.grams", x["gram"]))
    own = candidates.select("_row", "doc_id", "t.license", "t.n", "t.widest", F.explode(shown).alias("_p")).select("_row", "doc_id", "license", "n", "widest", "_p.at", "_p.gram")
    keys = ["_row", "doc_id", "license", "n", "widest"]
    order = Window.partitionBy(*keys).orderBy("gram", "at")
    before = F.when(F.lag("gram").over(order) == F.col("gram"), F.lag("at").over(order))
    placed = own.withColumn("before", before).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("at", "before"))).alias("_at"))
    best = placed.withColumn("_best", best_stretch(F.col("_at"), F.col("n"), F.col("widest"))).filter(F.col("_best.dice") >= min_dice)
    return best.select("_row", "doc_id", "license", "_best.dice", (-F.col("_best.first")).cast("long").alias("first_word"))


def license_report(docs: DataFrame) -> DataFrame:
    return license_matches(docs).select("doc_id", "license", "dice", "first_word")


def report_sql(templates: dict[str, str] = TEMPLATES, min_dice: float = MIN_DICE) -> str:
    """The report in SQL, from the same templates: all stretches between shared bigrams, without candidates."""
    share = min_dice / (2 - min_dice)
    values = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in templates.items())
    words = "string_split(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'), ' ')"
    return f"""
WITH v AS (SELECT license, {words.format('body')} AS w FROM (VALUES {values}) v(license, body)),
t AS (SELECT DISTINCT license, gram FROM (SELECT license, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram FROM v) WHERE NOT gram LIKE ' %' AND NOT gram LIKE '% '),
s AS (SELECT license, count(*) AS n FROM t GROUP BY license),
d AS (SELECT row_number() OVER () AS r, doc_id, {words.format('text')} AS w FROM documents WHERE text IS NOT NULL),
g AS (SELECT r, doc_id, unnest(range(0, len(w) - 1)) AS place, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram FROM d),
h AS (SELECT r, doc_id, license, place, lag(place) OVER (PARTITION BY r, license, gram ORDER BY place) AS earlier FROM g JOIN t USING (gram)),
c AS (SELECT r, license, count(*) FILTER (earlier IS NULL) AS k FROM h GROUP BY ALL),
p AS (SELECT h.* , n FROM h JOIN c USING (r, license) JOIN s USING (license) WHERE k >= ceil({share!r} * n)),
e AS (SELECT a.r, a.doc_id, a.license, a.place AS start, b.place AS stop, a.n, sum(CASE WHEN coalesce(b.earlier, -1) < a.place THEN 1 ELSE 0 END) OVER w AS shared, count(*) OVER w AS places
  FROM p a JOIN p b ON a.r = b.r AND a.license = b.license AND b.place >= a.place AND b.place - a.place < floor(a.n / {share!r})
  WINDOW w AS (PARTITION BY a.r, a.license, a.place ORDER BY b.place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
f AS (SELECT r, doc_id, license, start, 2.0 * shared / (shared + (stop - start + 1 - places) + n) AS dice FROM e)
SELECT doc_id, license, CAST(max(dice) AS DOUBLE) AS dice, arg_max(start, dice * 1e9 - start) AS first_word FROM f WHERE dice >= {min_dice} GROUP BY r, doc_id, license
"""
