"""License scans by conditional compression: how much a template, as raw dictionary, shortens a block."""

from __future__ import annotations

import re
from collections.abc import Mapping
from difflib import SequenceMatcher

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Wordings of public licence notices: fixed values.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "rights-reserved": "All rights reserved.",
}
#: Every template has one of these in it. Between two words anything but letters and digits, as notices are wrapped and commented.
CUES = r"licen[sc]e|redistribut|hereby[\W_]+granted|rights[\W_]+reserved"
CUE = re.compile(CUES, re.IGNORECASE)
WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
SCHEMA = "array<struct<start:int,license:string,plain_bytes:int,given_bytes:int,missing:array<string>,added:array<string>,exact:boolean>>"
LEVEL = 9
WINDOW = 6  # times the reach of a cue: what of a block is compressed at once


def blocks(text: str, reach: int) -> list[tuple[int, str]]:
    """Places that may hold a notice: ``reach`` characters around each cue, within the paragraph, joined where they touch."""
    found: list[list[int]] = []
    for cue in CUE.finditer(text):
        near = max(cue.start() - reach, 0)
        low = max(text.rfind("\n\n", near, cue.start()) + 1, near)
        high = text.find("\n\n", cue.end(), cue.end() + reach + 1)
        high = high if high >= 0 else min(len(text), cue.end() + reach)
        if found and low <= found[-1][1]:
            found[-1][1] = max(found[-1][1], high)
        else:
            found.append([low, high])
    return [(low, text[low:high]) for low, high in found]


def wording(block: str) -> tuple[list[str], list[int]]:
    """The words of a block in lower case, and where each begins."""
    words = list(WORD.finditer(block))
    return [w.group().lower() for w in words], [w.start() for w in words]


class Scanner:
    """Compressors for each template; made once per task."""

    def __init__(self, templates: Mapping[str, str], most_changes: float):
        self.templates = {name: wording(text)[0] for name, text in templates.items()}
        self.most_changes = most_changes
        self.reach = max(len(text) for text in templates.values()) + 20
        bare = {"level": LEVEL, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
        self.plain = zstandard.ZstdCompressor(**bare)
        self.given = {
            name: zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT), **bare)
            for name, text in templates.items()
        }

    def notice(self, words: list[str], name: str) -> tuple[int, int, list[str], list[str]] | None:
        """The stretch of ``words`` nearest to a template, with the template's words it lacks and those it adds."""
        template = self.templates[name]
        same = [m for m in SequenceMatcher(None, template, words, autojunk=False).get_matching_blocks() if m.size]
        if not same:
            return None
        core = max(same, key=lambda m: m.size)
        low = max(0, core.b - core.a - 3)
        near = words[low : core.b + len(template) - core.a + 3]
        steps = SequenceMatcher(None, template, near, autojunk=False).get_opcodes()
        kept = [s for s in steps if s[0] == "equal"]
        if not kept:
            return None
        first, last = kept[0][3], kept[-1][4]
        missing = [w for tag, a, b, _, _ in steps if tag in ("delete", "replace") for w in template[a:b]]
        added = [w for tag, _, _, a, b in steps if tag in ("insert", "replace") for w in near[max(a, first) : min(b, last)]]
        return low + first, low + last, missing, added

    def scan(self, text: str) -> list[tuple]:
        """The confirmed notices of a text, in time proportional to its length.

        A block of over ``WINDOW`` reaches is gone through in windows that overlap by two reaches; what begins in the overlap
        is left to the next window, which has it whole.
        """
        out = []
        for start, block in blocks(text, self.reach):
            at = 0
            while at < len(block):
                last = at + WINDOW * self.reach >= len(block)
                limit = len(block) if last else at + (WINDOW - 2) * self.reach
                found = [notice for notice in self.notices(block[at : at + WINDOW * self.reach]) if at + notice[0] < limit]
                out += [(start + at + low, *rest) for low, _, *rest in found]
                at = max([limit, *(at + high for _, high, *_ in found)])
        return sorted(out)

    def notices(self, window: str) -> list[tuple]:
        """The notices of a window, with their start and end. The template with the largest reduction is tried first; what it
        confirms is taken out, and the rest of the window is scanned again, until nothing is confirmed."""
        out = []
        pending = [(0, window)]
        while pending:
            at, part = pending.pop()
            if not CUE.search(part):
                continue
            data = part.lower().encode(errors="replace")
            plain = len(self.plain.compress(data))
            sizes = sorted((len(c.compress(data)), -len(self.templates[name]), name) for name, c in self.given.items())
            words, places = wording(part)
            for size, _, name in sizes:
                found = self.notice(words, name) if size < plain else None
                if found and len(found[2]) + len(found[3]) <= self.most_changes * len(self.templates[name]):
                    first, last, missing, added = found
                    end = places[last - 1] + len(words[last - 1])
                    out.append((at + places[first], at + end, name, plain, size, missing, added, not missing and not added))
                    pending += [(at, part[: places[first]]), (at + end, part[end:])]
                    break
        return out


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, most_changes: float = 0.2, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per licence notice: ``doc_id``, ``start`` (character), ``license``, ``plain_bytes``, ``given_bytes``, ``missing``, ``added``, ``exact``.

    Candidate blocks are what surrounds a cue word. Each is compressed by itself and with each template as
    a zstandard raw dictionary; templates are tried from the largest reduction down (ties: the longer
    one, then by name), and the first whose wording differs by ``most_changes`` of its words at most wins:
    ``missing`` and ``added`` are those differences, case and punctuation aside. A template must hold a cue.
    Texts without a cue never leave the JVM. Whole texts are scanned, however long.

    A NULL or empty text, and one without notices, gives no row. NULL ids are kept, repeated rows give repeated
    results, an empty table none. Other columns are not looked at.
    """
    fixed = dict(templates)

    @F.pandas_udf(SCHEMA)
    def scanned(texts: pd.Series) -> pd.Series:
        scanner = Scanner(fixed, most_changes)
        return pd.Series([scanner.scan(x) for x in texts])

    hinted = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).where(F.col("text").rlike(f"(?i){CUES}"))
    return hinted.select("doc_id", F.inline(scanned("text")))
