"""License scans by conditional compression.

A candidate block is a stretch of a text with enough of a template's words, wherever
it stands and however its lines break. Blocks are compressed with each template that
they may say as raw zstandard dictionary and ranked by the bytes that it saves;
exact comparison of words confirms or rejects a template and says what is worded
differently. Of blocks that overlap the one with the largest reduction stays.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklogs.llm.common import table

_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAMES = " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_CC = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
#: Public notices and texts by SPDX identifier.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        _BSD + _BSD_NAMES,
    ],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License.", _BSD],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    **{
        f"CC-{short}-4.0": [f"Licensed under CC {short} 4.0.", f"This work is licensed under a Creative Commons {long} 4.0 International License."]
        for short, long in _CC.items()
    },
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0."],
    "Proprietary": ["All rights reserved.", "This software is proprietary and confidential.", "Unauthorized copying of this file, via any medium, is strictly prohibited."],
}
for _name, _texts in TEMPLATES.items():
    if _name != "Proprietary":
        _texts.append(f"SPDX-License-Identifier: {_name}")
#: Words that tell licenses apart; a stretch that adds or lacks one is another license or none.
IDENTIFYING = {"Affero", "Lesser", "Library", "MIT", "Apache", "Mozilla", "BSD", "GNU", "2-Clause", "3-Clause", "4-Clause", "CC0", "no", "No", "NO", "not", "Not", "NOT", *_CC, *_CC.values()}
_WORD = re.compile(r"[\w.+-]*\w")
#: A word right before a stretch that denies it.
_DENIED = re.compile(r"\b(?:not|never|neither|nor)\s+(?:be\s+)?$", re.IGNORECASE)
#: A confirmed stretch says at least this part of the template's words, in order.
MIN_WORDING = 0.9

OUT = "doc_id long, licenses array<struct<license: string, start: int, end: int, saved: double, wording: double, differs: string>>"


@lru_cache(maxsize=4096)
def _meant(template: str) -> list[str]:
    return _WORD.findall(template)


def _need(template: str, min_wording: float) -> int:
    """Words that a stretch must say."""
    return math.ceil(min_wording * len(_meant(template)) - 1e-9)


def _reach(words: int) -> int:
    """Words of a stretch that may say a template of so many words: a quarter more, and at least two."""
    return words + max(2, words // 4)


@lru_cache(maxsize=4096)
def _distinct(template: str) -> frozenset[str]:
    return frozenset(_meant(template))


@lru_cache(maxsize=512)
def _press(template: str) -> zstandard.ZstdCompressor:
    primed = zstandard.ZstdCompressionDict(template.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT) if template else None
    return zstandard.ZstdCompressor(level=19, dict_data=primed, write_content_size=False, write_dict_id=False)


def reduction(block: bytes, template: str) -> int:
    """Compressed bytes that the template saves as raw dictionary."""
    return len(_press("").compress(block)) - len(_press(template).compress(block))


def wording(block: str, template: str) -> tuple[float, int, int, str]:
    """(part of the template's words said in order, start and end in the block, differences) by comparing words exactly.

    Differences read `-word` for the template's and `+word` for the block's; what the block says before and after the template's words is none.
    """
    spots = list(_WORD.finditer(block))
    said, meant = [m.group() for m in spots], _meant(template)
    matcher = SequenceMatcher(None, said, meant, autojunk=False)
    hits = [m for m in matcher.get_matching_blocks() if m.size]
    if not hits:
        return 0.0, 0, 0, ""
    differs = []
    for op, a, b, c, d in matcher.get_opcodes():
        if op == "equal":
            continue
        new = said[a:b]
        if b <= hits[0].a:  # before the first common word only as many as the template has there
            new = new[len(new) - min(len(new), d - c) :]
        elif a >= hits[-1].a + hits[-1].size:
            new = new[: d - c]
        differs += [f"-{w}" for w in meant[c:d]] + [f"+{w}" for w in new]
    first, last = spots[hits[0].a], spots[hits[-1].a + hits[-1].size - 1]
    return sum(m.size for m in hits) / len(meant), first.start(), last.end(), " ".join(differs)


def _counts(said: list[str], meant: list[str]) -> list[int]:
    """For each word how many of `meant` are among the next `_reach` words, in any order."""
    wanted, span = Counter(meant), _reach(len(meant))
    have: Counter = Counter()
    common, counts = 0, []
    for k in range(len(said) + span - 1):
        if k < len(said) and said[k] in wanted:
            have[said[k]] += 1
            common += have[said[k]] <= wanted[said[k]]
        if k >= span and said[k - span] in wanted:
            have[said[k - span]] -= 1
            common -= have[said[k - span]] < wanted[said[k - span]]
        counts.append(common)
    return counts[span - 1 :]


def _confirmed(text: str, words: list[re.Match], template: str, min_wording: float):
    """(words said, wording, differences, start, end) of the non-overlapping stretches of a text that say the template, from left to right in one pass.

    Words are compared where enough of the template's words are in reach and it may
    begin: at its first word, and where the number in reach falls again.
    """
    meant = _meant(template)
    need = _need(template, min_wording)
    said = [w.group() for w in words]
    counts = _counts(said, meant)
    k = free = 0  # the first word that no stretch has
    while k < len(counts):
        if counts[k] < need or said[k] != meant[0] and k + 1 < len(counts) and counts[k + 1] >= counts[k]:
            k += 1
            continue
        before = max(free, k - (len(meant) - need))
        some = words[before : k + _reach(len(meant))]
        origin = some[0].start()
        part, s, e, differs = wording(text[origin : some[-1].end()], template)
        s, e = origin + s, origin + e
        k += 1
        if part >= min_wording and not IDENTIFYING & {w[1:] for w in differs.split()} and not _DENIED.search(text, max(0, s - 16), s):
            yield round(part * len(meant)), part, differs, s, e
            while before < len(words) and words[before].start() < e:
                before += 1
            k = free = max(k, before)


def scan(text: str | None, templates: dict[str, list[str]] = TEMPLATES, min_wording: float = MIN_WORDING) -> list[dict]:
    """All confirmed licenses of a text that don't overlap, in its order; null counts as empty."""
    text = text or ""
    words = list(_WORD.finditer(text))
    have = {w.group() for w in words}
    tried = []
    for name, ts in templates.items():
        for template in ts:
            # a word that the text lacks is at least one that a stretch doesn't say
            if len(_distinct(template) - have) > len(_meant(template)) - _need(template, min_wording):
                continue
            for said, part, differs, s, e in _confirmed(text, words, template, min_wording):
                reduced = reduction(text[s:e].encode("utf-8", "replace"), template)
                tried.append((-reduced, len(differs.split()) - said, -part, name, s, e, reduced / max(1, len(template.encode())), differs))
    out: list[dict] = []
    taken: list[tuple[int, int]] = []  # in order
    for _, _, part, name, s, e, saved, differs in sorted(tried):
        at = bisect_left(taken, (s, e))
        if (at == 0 or taken[at - 1][1] <= s) and (at == len(taken) or e <= taken[at][0]):
            taken.insert(at, (s, e))
            out.append({"license": name, "start": s, "end": e, "saved": saved, "wording": -part, "differs": differs})
    return sorted(out, key=lambda x: x["start"])


def license_scan(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text", min_wording: float = MIN_WORDING) -> DataFrame:
    """(doc_id, licenses): one row per row of `docs`; spans in code points, end exclusive, in the order of the text.

    `templates` (names to texts) travel to every task, so they are meant to be at
    most a few thousand short texts. Whole texts are scanned; null and empty texts
    have no licenses. Ids may be null or repeat; other columns are not read.
    """
    kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("saved", pa.float64()), ("wording", pa.float64()), ("differs", pa.string())]))

    def each(batches):
        for batch in batches:
            found = [scan(t.as_py(), templates, min_wording) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["doc_id", "licenses"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(each, OUT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(table(spark, sf_dir, "documents"))
    spans = F.transform("licenses", lambda x: F.concat_ws(":", x.license, x.start, x.end))
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_licenses"), F.array_join(spans, ",").alias("spans"), F.array_join(F.transform("licenses", lambda x: x.differs), ";").alias("differs"))
