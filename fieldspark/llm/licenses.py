"""License scans with DataFrame functions only: normalised text units compared to licence templates by the Dice
coefficient of their word bigrams; bounds on the number of bigrams choose the templates that a unit is compared to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.llm.shared import LOWER, UPPER, Packed, spread, table

THRESHOLD = 0.8
# Public notices by which texts name their licence, by SPDX name.
NOTICES = [
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("Artistic-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the Artistic License 2.0."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CDDL-1.0", "The contents of this file are subject to the terms of the Common Development and Distribution License. You may not use this file except in compliance with the License."),
    ("EPL-1.0", "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("EUPL-1.2", "Licensed under the EUPL, Version 1.2 only. You may not use this work except in compliance with the Licence."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MS-PL", "This software is released under the Microsoft Public License."),
    ("ODbL-1.0", "This database is made available under the Open Database License: http://opendatacommons.org/licenses/odbl/1.0/."),
    ("OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    ("PostgreSQL", "Released under the PostgreSQL License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
]

# Whole licences, without their copyright lines.
BODIES = [
    ("0BSD", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("BSD-2-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("BSD-3-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("BSL-1.0", 'Boost Software License - Version 1.0 - August 17th, 2003 Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("Unlicense", 'This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to <http://unlicense.org/>'),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
]
TEMPLATES = NOTICES + BODIES


def normalised(text: Column) -> Column:
    """A-Z lower-cased, every run of other ASCII than letters, digits and line feeds made one space."""
    return F.translate(F.regexp_replace(text, r"[\x00-\x09\x0B-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " "), UPPER, LOWER)


def words_of(unit: Column) -> Column:
    return F.filter(F.split(unit, "[ \n]"), lambda w: w != "")


def bigrams(words: Column) -> Column:
    """The distinct pairs of neighbours in an array of words (a plain column: it is evaluated more than once)."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b)))


def template_sets(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """(template, license, grams) of each template that has two words or more."""
    rows = spark.createDataFrame([(i, name, said) for i, (name, said) in enumerate(templates)], "template int, license string, said string").coalesce(1)
    rows = rows.select("template", "license", words_of(normalised(F.col("said"))).alias("words"))
    return rows.select("template", "license", bigrams(F.col("words")).alias("grams")).where(F.size("grams") > 0)


def by_size(sets: DataFrame, threshold: float) -> DataFrame:
    """A row for each template and number n of bigrams with which 2 * min(n, m) / (n + m) can reach the threshold."""
    m = F.size("grams")
    low, high = F.ceil(m * threshold / (2 - threshold) - 1e-9), F.floor(m * (2 - threshold) / threshold + 1e-9)
    return sets.select("template", "license", "grams", F.explode(F.sequence(F.greatest(F.lit(1), low.cast("int")), high.cast("int"))).alias("n"))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``license`` (of the best match: highest Dice, then first name), ``dice``, ``n_matches`` (units of the
    text that match a template) and ``licenses`` (all names that match, sorted) after its columns.

    The units of a text are its lines, its paragraphs of more than one line (between blank lines) and the whole where it
    has more than one paragraph. Units that match nothing, and texts that are null or empty, have null, 0.0, 0 and no
    names. The templates are a fixed parameter and the only thing broadcast; units whose size fits no template, or that
    share too few bigrams with all templates together, are dropped before they meet any. Without ``keep_text`` the text doesn't pass, and none is shuffled. Columns of the four new
    names are replaced, others pass through.
    """
    spark = docs.sparkSession
    new = {"license": T.StringType(), "dice": T.DoubleType(), "n_matches": T.LongType(), "licenses": T.ArrayType(T.StringType())}
    sets = template_sets(spark, templates)
    sized = by_size(sets, threshold)
    sizes = [r["n"] for r in sized.select("n").distinct().collect()] or [1]  # of the fixed templates
    least, most = min(sizes), max(sizes)
    smallest, known = sets.agg(F.coalesce(F.min(F.size("grams")), F.lit(1)), F.array_distinct(F.flatten(F.collect_list("grams")))).first()

    packed = Packed(docs, text, new, keep_text)
    held = F.struct("row", "text") if packed.keeps_text else F.struct("row")
    rows = packed.rows.select(F.monotonically_increasing_id().alias("rid"), held.alias("row"), normalised(F.coalesce("text", F.lit(""))).alias("said"))
    rows = rows.withColumn("paragraphs", F.split("said", "\n ?(?:\n ?)+"))
    none = F.array().cast("array<string>")
    units = F.concat(
        F.split("said", "\n"),
        F.filter("paragraphs", lambda p: F.contains(p, F.lit("\n"))),
        F.when(F.size("paragraphs") > 1, F.array("said")).otherwise(none),
    )
    # all different words of a unit but the last begin a bigram each, so of those with too many none are made
    few = lambda w: (F.size(w) <= most + 1) | (F.size(F.array_distinct(w)) <= most + 1)
    long_enough = F.filter(F.transform(units, words_of), lambda w: (F.size(w) > least) & few(w))
    cut = rows.select("rid", "row", F.posexplode_outer(long_enough).alias("unit", "words"))
    cut = cut.select("rid", F.when(F.coalesce("unit", F.lit(0)) == 0, F.col("row")).alias("row"), "unit", bigrams(F.col("words")).alias("own"))
    # a unit meets templates only if enough of its bigrams are those of any
    n, common = F.size("own"), F.size(F.filter("own", lambda g: g.isin(known)))
    cut = cut.withColumn("n", F.when((n <= most) & (2 * common >= threshold * (n + smallest) - 1e-9), n)).where("n is not null or row is not null")
    met = cut.join(F.broadcast(sized), "n", "left")
    dice = 2 * F.size(F.array_intersect("own", "grams")) / (F.col("n") + F.size("grams"))
    met = met.select("rid", "row", "unit", "license", F.coalesce(dice, F.lit(0.0)).alias("dice"))
    hit = F.col("dice") >= threshold
    # a row for each text and each match is all that is shuffled
    met = met.where(hit | F.col("row").isNotNull()).withColumns({"unit": F.when(hit, F.col("unit")), "license": F.when(hit, F.col("license")), "dice": F.when(hit, F.col("dice"))})
    met = met.groupBy("rid", "unit").agg(F.first("row", ignorenulls=True).alias("row"), F.collect_set("license").alias("names"), F.max("dice").alias("dice"), F.min_by("license", F.struct(-F.col("dice"), "license")).alias("license"))
    out = met.groupBy("rid").agg(
        F.first("row", ignorenulls=True).alias("row"),
        F.min_by("license", F.when(F.col("dice").isNotNull(), F.struct(-F.col("dice"), "license"))).alias("license"),
        F.coalesce(F.max("dice"), F.lit(0.0)).alias("dice"),
        F.count("unit").alias("n_matches"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("licenses"),
    )
    return packed.unpacked(out.select("row.*", *new), *[F.col(c) for c in new])


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), keep_text=False)
    return out.select("doc_id", "license", "dice", "n_matches", F.array_join("licenses", ",").alias("licenses"))


_VALUES = ", ".join(f"({i}, '{name}', '{said.replace(chr(39), chr(39) * 2)}')" for i, (name, said) in enumerate(TEMPLATES))
OP8_SQL = rf"""
with templates(template, license, said) as (values {_VALUES}),
said as (
  select row_number() over () as rid, doc_id, translate(regexp_replace(coalesce(text, ''), '[\x00-\x09\x0B-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+', ' ', 'g'), '{UPPER}', '{LOWER}') as t from documents
), paragraphs as (
  select rid, t, regexp_split_to_array(t, '\n ?(?:\n ?)+') as p from said
), units as (
  select rid, unnest(string_split(t, chr(10))) as u, 'line' as kind, generate_subscripts(string_split(t, chr(10)), 1) as k from said
  union all select rid, u, 'paragraph', k from (select rid, unnest(p) as u, generate_subscripts(p, 1) as k from paragraphs) where contains(u, chr(10))
  union all select rid, t, 'whole', 0 from paragraphs where len(p) > 1
), words as (
  select rid, kind, k, list_filter(regexp_split_to_array(u, '[ \n]'), lambda w: w <> '') as w from units
), grams as (
  select rid, kind, k, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as own from words where len(w) > 1
), template_words as (
  select template, license, list_filter(string_split(translate(regexp_replace(said, '[\x00-\x09\x0B-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+', ' ', 'g'), '{UPPER}', '{LOWER}'), ' '), lambda w: w <> '') as w from templates
), template_grams as (
  select template, license, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as grams from template_words
), matches as (
  select * from (
    select rid, kind, k, license, 2 * len(list_intersect(own, grams)) / (len(own) + len(grams)) as dice
    from grams join template_grams on list_has_any(own, grams)
  ) where dice >= {THRESHOLD}
), best as (
  select rid, arg_min(license, struct_pack(d := -dice, l := license)) as license, max(dice) as dice, count(distinct kind || k) as n_matches, string_agg(distinct license, ',' order by license) as licenses
  from matches group by rid
)
select doc_id, license, coalesce(dice, 0.0) as dice, coalesce(n_matches, 0) as n_matches, coalesce(licenses, '') as licenses
from said left join best using (rid)
"""
