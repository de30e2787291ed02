"""License scans by sentence rules: sentences become identifiers, sequences of identifiers are matched to license rules.

A rule is the text of a notice.  Notices and documents go through the same expressions: comment leaders are dropped, the
text is cut into sentences after ``. ! ?`` and white space unless a digit follows, and after a colon before a capitalised
word with another behind it or a list number, a sentence is lower-cased,
everything but letters and digits becomes one space, and copyright notices are reduced to one word.  Each distinct
sentence of the notices has an identifier, and a rule is the sequence of its sentences' identifiers; sentences of fewer
than ``SHORTEST`` words (list numbers, "and") are in no rule.  Documents are cut in two ways, at line ends as well, and
at blank lines in place of line ends (wrapped paragraphs).  A rule is met where its identifiers follow one another in a
cut with at most ``GAP`` other sentences between two.  Texts without any of the words that all known sentences share one
of are not cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusproof.llm.native import row_key

GAP = 3
SHORTEST = 3

_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_SOURCE = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_BINARY = """Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_INTRO = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_NAMES = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission."""
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""
_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS."""


def _gnu(name: str, version: str, or_later: bool, what: str = "This program") -> str:
    """The notice that the GNU licenses ask for."""
    choice = f"either version {version} of the License, or (at your option) any later version" if or_later else f"version {version} of the License"
    return f"""{what} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software
Foundation, {choice}. {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."""


# fixed values: notices of licenses, as their publishers word them
RULES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may
obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and limitations under the License.""",
    ),
    (
        "apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.

You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and limitations under the License.""",
    ),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

"""
        + _WARRANTY,
    ),
    ("mit-0", f"""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.

{_WARRANTY}"""),
    ("isc", f"""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the
above copyright notice and this permission notice appear in all copies.

{_ISC_WARRANTY}"""),
    ("isc", f"""Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the
above copyright notice and this permission notice appear in all copies.

{_ISC_WARRANTY}"""),
    ("0bsd", f"""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

{_ISC_WARRANTY}"""),
    ("bsd-2-clause", f"{_BSD_INTRO}\n\n1. {_BSD_SOURCE}\n\n2. {_BSD_BINARY}\n\n{_BSD_WARRANTY}"),
    ("bsd-3-clause", f"{_BSD_INTRO}\n\n1. {_BSD_SOURCE}\n\n2. {_BSD_BINARY}\n\n3. {_BSD_NAMES}\n\n{_BSD_WARRANTY}"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0-or-later", _gnu("GNU General Public License", "3", True)),
    ("gpl-3.0-only", _gnu("GNU General Public License", "3", False)),
    ("gpl-2.0-or-later", _gnu("GNU General Public License", "2", True)),
    ("gpl-2.0-or-later", _gnu("GNU General Public License", "2", True).replace("software: you", "software; you")),
    ("gpl-2.0-only", _gnu("GNU General Public License", "2", False)),
    ("lgpl-3.0-or-later", _gnu("GNU Lesser General Public License", "3", True)),
    ("lgpl-2.1-or-later", _gnu("GNU Lesser General Public License", "2.1", True, "This library")),
    ("agpl-3.0-or-later", _gnu("GNU Affero General Public License", "3", True)),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0."),
    (
        "unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    ),
    (
        "zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages
arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications,
and to alter it and redistribute it freely, subject to the following restrictions:""",
    ),
    ("wtfpl", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nd-4.0", "Licensed under CC BY-ND 4.0."),
    ("cc-by-nc-sa-4.0", "Licensed under CC BY-NC-SA 4.0."),
    *((f"cc-{kind}-4.0", f"This work is licensed under a Creative Commons {name} 4.0 International License.") for kind, name in (("by", "Attribution"), ("by-sa", "Attribution-ShareAlike"), ("by-nc", "Attribution-NonCommercial"), ("by-nd", "Attribution-NoDerivatives"), ("by-nc-sa", "Attribution-NonCommercial-ShareAlike"), ("by-nc-nd", "Attribution-NonCommercial-NoDerivatives"))),
    ("cc0-1.0", "Released under CC0 1.0 Universal Public Domain Dedication."),
    *((name.lower(), f"SPDX-License-Identifier: {name}") for name in ("Apache-2.0", "MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later", "MPL-2.0", "EPL-2.0", "BSL-1.0", "Unlicense", "Zlib", "CC0-1.0", "CC-BY-4.0", "0BSD")),
    ("all-rights-reserved", "All rights reserved."),
]
#: Words one of which stands in every sentence of the notices above.
SIGNS = ("licens", "copyright", "permi", "software", "redistribut", "reserved", "cc0", "warrant", "program", "library", "liable", "eclipse", "mozilla")

_END = "(?<=[.!?])\\s+(?=[^\\s0-9])|(?<=:)\\s+(?=\\p{Lu}\\S*[ \\t]+\\p{L}|[0-9]+[.)]\\s)"


def sentences_of(text: Column, line_ends: bool) -> Column:
    """The text's sentences, normalised, in order; blank ones keep their place."""
    bare = F.regexp_replace(text, "(?m)^[ \\t]*(?:/\\*+|\\*+/?|#+|//+|--+|;+|%+|<!--|-->)[ \\t]?", "")
    pieces = F.split(bare, _END + ("|\\n+" if line_ends else "|\\n\\s*\\n"))
    plain = lambda s: F.trim(F.regexp_replace(F.lower(s), "[^\\p{L}\\p{N}]+", " "))
    return F.transform(F.transform(pieces, plain), lambda s: F.when(s.rlike("^copyright( c)? [0-9]{4}"), F.lit("copyright")).otherwise(s))


def license_matches(documents: DataFrame, rules: list[tuple[str, str]] | None = None, signs: tuple[str, ...] | None = None, gap: int = GAP) -> DataFrame:
    """(doc_id, license, rule, first_sentence, last_sentence, cut, times) of each rule met in a text.

    ``rules`` are (license, text of the notice); ``signs`` are the words one of which a text must hold to be looked at:
    ``SIGNS`` for the rules above, none (all texts) for other rules.  rule is the number of the rule; sentences are
    counted from 0 in that cut ("line" or "paragraph"; a match found in both is given for "line").  times counts the
    places, first_sentence and last_sentence are the first one's.  A rule whose sentences are part of another that is met
    in the same text is given as well.  Null and empty texts match nothing.  Rows that repeat a doc_id with the same text
    count once; null ids stay null; other columns are ignored; an empty table gives no rows.
    """
    signs = signs if signs is not None else SIGNS if rules is None else ()
    rules = rules or RULES
    notices = F.array(*(F.struct(F.lit(k).alias("rule"), F.lit(name).alias("license"), F.lit(text).alias("text")) for k, (name, text) in enumerate(rules)))
    known = F.filter(sentences_of(F.col("n.text"), False), lambda s: F.size(F.split(s, " ")) >= SHORTEST)
    steps = documents.sparkSession.range(1).select(F.explode(notices).alias("n")).select("n.rule", "n.license", known.alias("s"))
    # sentences by their identifiers, a hash; as many rows as the notices have sentences
    steps = steps.select("rule", "license", F.size("s").alias("steps"), F.posexplode("s").alias("step", "s")).select("rule", "license", "steps", "step", F.xxhash64("s").alias("id"))
    low = F.lower(F.col("text"))
    texts = row_key(documents.select("doc_id", F.col("text").cast("string").alias("text")))
    if signs:
        texts = texts.where(low.rlike("|".join(signs)))
    texts = texts.where("text is not null").dropDuplicates(["key", "tie"])
    cuts = F.array(*(F.struct(F.lit(name).alias("cut"), F.transform(sentences_of(F.col("text"), name == "line"), lambda s: F.xxhash64(s)).alias("ids")) for name in ("line", "paragraph")))
    pieces = texts.select("key", "tie", F.explode(cuts).alias("c")).select("key", "tie", "c.cut", F.posexplode("c.ids").alias("pos", "id"))
    walked = pieces.join(F.broadcast(steps), "id").groupBy("key", "tie", "cut", "rule", "license", "steps").agg(F.sort_array(F.collect_list(F.struct("pos", "step"))).alias("seen"))
    state = "struct<next:int,first:int,last:int,found:array<struct<first:int,last:int>>>"

    def advance(acc, x):
        late = (acc["next"] > 0) & (x["pos"] - acc["last"] > gap + 1)
        at = F.when(late, F.lit(0)).otherwise(acc["next"])
        fits, again = x["step"] == at, x["step"] == 0
        first = F.when((fits & (at == 0)) | (~fits & again), x["pos"]).otherwise(acc["first"])
        following = F.when(fits, at + 1).when(again, F.lit(1)).otherwise(at)
        last = F.when(fits | again, x["pos"]).otherwise(acc["last"])
        done = following == F.col("steps")
        found = F.when(done, F.concat(acc["found"], F.array(F.struct(first.alias("first"), last.alias("last"))))).otherwise(acc["found"])
        return F.struct(F.when(done, F.lit(0)).otherwise(following).alias("next"), first.alias("first"), last.alias("last"), found.alias("found")).cast(state)

    start = F.struct(F.lit(0).alias("next"), F.lit(-1).alias("first"), F.lit(-1).alias("last"), F.array().cast("array<struct<first:int,last:int>>").alias("found")).cast(state)
    met = walked.withColumn("found", F.aggregate("seen", start, advance)["found"]).where(F.size("found") > 0)
    best = met.groupBy("key", "tie", "rule", "license").agg(F.min(F.struct("cut", "found")).alias("m"))
    doc_id = F.when(F.col("key") != -(2**63), F.col("key")).alias("doc_id")
    return best.select(doc_id, "license", "rule", F.col("m.found")[0]["first"].alias("first_sentence"), F.col("m.found")[0]["last"].alias("last_sentence"), F.col("m.cut").alias("cut"), F.size("m.found").alias("times"))
