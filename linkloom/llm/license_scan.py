"""License notices found by conditional compression.

Mentions of licensing are grown to blocks of neighbouring text, across lines. A block, without
comment markers, is compressed with zstandard by itself and with each template as raw
dictionary; templates are ranked by the share of the block's size that the dictionary saves.
The best ones, and all whose words the block holds, are confirmed by exact wording differences:
the words that the block adds to and drops from the template.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import text_or_empty

#: Short notices and well-known opening sentences of licenses, by SPDX identifier.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license. See the LICENSE file in the project root for license information.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
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
    "BSD-3-Clause": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "BSD-2-Clause": [
        "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "CC-BY-4.0": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "CC-BY-SA-4.0": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "CC-BY-ND-4.0": [
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "Licensed under CC BY-ND 4.0.",
    ],
    "CC-BY-NC-4.0": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "CC-BY-NC-SA-4.0": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.",
    ],
    "CC-BY-NC-ND-4.0": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
        "Licensed under CC BY-NC-ND 4.0.",
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
    "ISC": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "Unlicense": [
        "Released under the Unlicense.",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. This work is dedicated to the public domain under CC0 1.0."],
}
#: A line can hold a notice only if one of these occurs in it.
TRIGGER = r"(?i)licen[sc]|copyright|redistribut|permission is hereby|public domain|waived all"
SCHEMA = "doc_id long, block_start long, block_end long, license string, template long, saved double, words_added array<string>, words_dropped array<string>, confirmed boolean"

_WORD = re.compile(r"[^\W_]+", re.UNICODE)
#: What begins or ends a line of a comment.
_COMMENT = re.compile(r"(?m)^[ \t]*(?:(?:/\*+|\*+/?|//+|#+|;+|--+|%+|<!--+|>+|(?:rem|REM|dnl)\b)[ \t]*)+|[ \t]*(?:\*+/|--+>)[ \t]*$")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@lru_cache(maxsize=8)
def _compressors(templates: tuple, level: int) -> list:
    plain = zstandard.ZstdCompressor(level=level, write_content_size=False, write_checksum=False, write_dict_id=False)
    with_dict = [
        (name, k, t, words_of(t), zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(t.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False, write_dict_id=False))
        for name, texts in templates
        for k, t in enumerate(texts)
    ]
    return [plain, with_dict]


def spans(text: str, trigger: re.Pattern, context: int) -> list[tuple[int, int]]:
    """Candidate blocks: ``context`` characters (to whole words) before and after each trigger, across lines; touching blocks are one."""
    out: list[list[int]] = []
    for m in trigger.finditer(text):
        start, end = max(0, m.start() - context), min(len(text), m.end() + context)
        while start > 0 and not text[start - 1].isspace():
            start -= 1
        while end < len(text) and not text[end].isspace():
            end += 1
        if out and start <= out[-1][1]:
            out[-1][1] = max(end, out[-1][1])
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def best_window(block: list[str], template: list[str]) -> tuple[int, int, int]:
    """The fewest words to add to and drop from the template to get a run of the block's words, and the first and the end of that run (the latest start, then the earliest end)."""
    number = {w: k for k, w in enumerate(dict.fromkeys(template))}
    wanted = np.array([number[w] for w in template])
    # cost[j] = cost * one - start, for a run that ends here and template[:j]
    one = len(block) + 1
    down = np.arange(len(template) + 1) * one
    cost = down.copy()
    best, until = int(cost[-1]), 0
    for i, w in enumerate(block):
        new = cost + one
        new[0] = -(i + 1)
        if w in number:
            new[1:] = np.where(wanted == number[w], np.minimum(new[1:], cost[:-1]), new[1:])
        cost = np.minimum.accumulate(new - down) + down
        if cost[-1] < best and -(-cost[-1] // one) < -(-best // one):
            best, until = int(cost[-1]), i + 1
    changes = -(-best // one)
    return changes, changes * one - best, until


def scan(text: str, templates: tuple, trigger: re.Pattern, context: int, level: int, confirm_best: int, max_changed: float) -> list[tuple]:
    """Rows for one text: (start, end, license, template, saved, added, dropped, confirmed): for each block one for each license confirmed in it, or the likeliest if there is none."""
    plain, with_dict = _compressors(templates, level)
    rows = []
    for start, end in spans(text, trigger, context):
        block = _COMMENT.sub("", text[start:end])
        data = block.encode()
        alone = len(plain.compress(data))
        ranked = sorted(((1 - len(c.compress(data)) / alone, name, k, words) for name, k, _, words, c in with_dict), key=lambda x: (-x[0], x[1], x[2]))
        block_words = words_of(block)
        held = Counter(block_words)
        compared = []
        for rank, (saved, name, k, template) in enumerate(ranked):
            wanted = Counter(template)
            if rank >= confirm_best and (wanted - held).total() > max_changed * max(1, len(template)):
                continue  # too many words are missing for it to be confirmed
            _, a, b = best_window(block_words, template)
            inside = Counter(block_words[a:b])
            added, dropped = sorted((inside - wanted).elements()), sorted((wanted - inside).elements())
            changed = (len(added) + len(dropped)) / max(1, len(template))
            compared.append((changed > max_changed, changed, -saved, (inside & wanted).total() - len(added) - len(dropped), a, b, (start, end, name, k, round(saved, 6), added, dropped, changed <= max_changed)))
        confirmed: list[tuple] = []
        # where wordings of several licenses overlap, the one that explains most words holds
        for x in sorted((x for x in compared if not x[0]), key=lambda x: (-x[3], *x[1:3], x[6][2:4])):
            if all(x[6][2] != y[6][2] and (x[5] <= y[4] or y[5] <= x[4]) for y in confirmed):
                confirmed.append(x)
        rows += [x[6] for x in sorted(confirmed, key=lambda x: x[4])] or [min(compared, key=lambda x: x[:3])[6]]
    return rows


def license_scan(docs: DataFrame, *, templates: dict[str, list[str]] | None = None, trigger: str = TRIGGER, context: int = 600, level: int = 3, confirm_best: int = 3, max_changed: float = 0.2) -> DataFrame:
    """A row for each license confirmed in each candidate block of every document; a block without one has a row with the license whose template explains it best.

    ``saved`` is the share of the block's compressed size that the template saves as raw
    dictionary. The ``confirm_best`` templates that save most, and all that could be confirmed,
    are compared word by word with the best matching run of the block; ``confirmed`` if words added and dropped are at most
    ``max_changed`` of the template's words. Positions count characters.
    Null and empty texts and texts without a trigger give no row; long texts are scanned whole;
    repeated rows give repeated results; a null doc_id stays null; an empty table gives an
    empty result; ties go to fewer changes, then to the license that comes first by name; other
    columns are ignored.
    """
    if confirm_best < 1:
        raise ValueError("confirm_best must be positive")
    fixed = tuple(sorted((name, tuple(texts)) for name, texts in (templates or TEMPLATES).items()))
    if not any(texts for _, texts in fixed):
        raise ValueError("there must be a template")
    names = [x.split()[0] for x in SCHEMA.replace("array<string>", "list").split(", ")]
    types = [pa.int64()] * 3 + [pa.string(), pa.int64(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.bool_()]
    schema = pa.schema(list(zip(names, types)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(trigger)
        for batch in batches:
            rows = [(i, *r) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for r in scan(t, fixed, find, context, level, confirm_best, max_changed)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    picked = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty(docs["text"]).alias("text"))
    return picked.where(F.col("text").rlike(trigger)).mapInArrow(run, SCHEMA)
