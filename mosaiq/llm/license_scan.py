"""License scans: a trained classifier names the family of a paragraph, and the family's texts confirm it.

The classifier is a sparse logistic regression over word n-grams of notices, trained here. N-grams without a weight say
nothing: a paragraph without a known one is of the unknown class by the model's own bias. Gates and bounds are worked out
from the weights within each row; only what the bound lets pass is scored, by joins and sums of DataFrames.
"""

from __future__ import annotations

import functools
import json
import math
import random
import re
from collections import Counter
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mosaiq.llm.common import text_of

UNKNOWN = "unknown"
#: A family is named from this calibrated probability on, and confirmed from this share of a template's n-grams on.
LEAST_PROBABILITY, LEAST_SIMILARITY = 0.5, 0.6
NGRAMS = (1, 2, 3)
#: Words of a run of lines that is looked at as one notice: about twice those of the longest template.
RUN_WORDS = 120
#: Cells of the table that bounds what a part can gain.
CELLS = 1 << 15
_SAID = r"[\p{L}\p{N}]"
_KEY = ["doc_id", "of", "paragraph"]

# How each family is called, and how its notices begin, as their publishers word them.
NAMES: dict[str, tuple[str, ...]] = {
    "agpl-3.0": ("AGPL-3.0", "AGPL-3.0-or-later", "AGPL-3.0-only", "GNU AGPLv3", "AGPLv3", "AGPL version 3", "GNU Affero General Public License version 3", "GNU Affero General Public License, version 3.0"),
    "all-rights-reserved": ("All rights reserved",),
    "apache-2.0": ("Apache-2.0", "Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0", "Apache 2", "Apache 2.0 License", "ASL 2.0"),
    "artistic-2.0": ("Artistic-2.0", "Artistic License 2.0", "Perl Artistic License"),
    "bsd": ("BSD-3-Clause", "BSD-2-Clause", "BSD 3-Clause License", "BSD 2-Clause License", "BSD License", "New BSD License", "Simplified BSD License", "three-clause BSD license", "BSD"),
    "bsl-1.0": ("BSL-1.0", "Boost Software License 1.0", "Boost Software License, Version 1.0", "Boost Software License"),
    "cc-by-4.0": ("CC-BY-4.0", "CC BY 4.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution License", "Creative Commons BY 4.0"),
    "cc-by-nc-4.0": ("CC-BY-NC-4.0", "CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "Creative Commons Attribution NonCommercial License", "CC BY-NC"),
    "cc-by-nc-nd-4.0": ("CC-BY-NC-ND-4.0", "CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License", "CC BY-NC-ND"),
    "cc-by-nc-sa-4.0": ("CC-BY-NC-SA-4.0", "CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "CC BY-NC-SA"),
    "cc-by-sa-4.0": ("CC-BY-SA-4.0", "CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "Creative Commons Attribution ShareAlike License", "CC BY-SA"),
    "cc0-1.0": ("CC0-1.0", "CC0 1.0", "CC0", "CC0 1.0 Universal", "Creative Commons Zero", "Creative Commons CC0 public domain dedication"),
    "cddl-1.0": ("CDDL-1.0", "CDDL", "Common Development and Distribution License", "CDDL version 1.0"),
    "epl-2.0": ("EPL-2.0", "Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License, version 2.0", "Eclipse Public License"),
    "eupl-1.2": ("EUPL-1.2", "EUPL", "European Union Public Licence 1.2", "European Union Public License"),
    "gpl-2.0": ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPLv2", "GPL v2", "GPLv2+", "GNU GPL version 2", "GNU General Public License version 2", "GNU General Public License, version 2", "GNU GPLv2"),
    "gpl-3.0": ("GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "GPLv3", "GPL v3", "GPLv3+", "GNU GPL version 3", "GNU General Public License version 3", "GNU General Public License, version 3", "GNU GPLv3"),
    "isc": ("ISC", "ISC License", "ISC licence"),
    "lgpl-2.1": ("LGPL-2.1", "LGPL-2.1-or-later", "LGPLv2.1", "LGPL v2.1", "GNU Lesser General Public License version 2.1", "GNU Lesser General Public License, version 2.1"),
    "lgpl-3.0": ("LGPL-3.0", "LGPL-3.0-or-later", "LGPLv3", "LGPL v3", "GNU Lesser General Public License version 3", "GNU Lesser General Public License, version 3", "GNU LGPLv3"),
    "mit": ("MIT", "MIT License", "MIT licence", "MIT-style license", "Expat License", "MIT/X11 license"),
    "mpl-2.0": ("MPL-2.0", "MPL 2.0", "Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License"),
    "ofl-1.1": ("OFL-1.1", "SIL Open Font License 1.1", "SIL Open Font License, Version 1.1", "Open Font License"),
    "psf-2.0": ("PSF-2.0", "Python Software Foundation License", "PSF License Agreement"),
    "public-domain": ("public domain", "public-domain"),
    "unlicense": ("Unlicense", "The Unlicense"),
    "wtfpl": ("WTFPL", "Do What The Fuck You Want To Public License"),
    "zlib": ("Zlib", "zlib license", "zlib/libpng license"),
}
TEXTS: dict[str, tuple[str, ...]] = {
    "agpl-3.0": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",),
    "all-rights-reserved": ("Copyright, all rights reserved. No part may be reproduced without permission.", "No part of this publication may be reproduced or transmitted in any form without the prior written permission of the publisher. All rights reserved."),
    "apache-2.0": ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "bsl-1.0": (
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)",
        'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software',
    ),
    "cc-by-4.0": ("This work is licensed under a Creative Commons Attribution 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/",),
    "cc0-1.0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "Dedicated to the public domain under CC0 1.0."),
    "epl-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0",),
    "gpl-2.0": ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",),
    "gpl-3.0": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",),
    "isc": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    "lgpl-2.1": ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",),
    "lgpl-3.0": ("This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",),
    "mit": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",),
    "ofl-1.1": ("This Font Software is licensed under the SIL Open Font License, Version 1.1. This license is available with a FAQ at http://scripts.sil.org/OFL",),
    "public-domain": ("Dedicated to the public domain.", "The author hereby places this work in the public domain.", "This file has been put into the public domain."),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "wtfpl": ("Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.",),
    "zlib": ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",),
}
# How a license is named in passing; the last few only set the temperature.
SAYINGS = (
    "SPDX-License-Identifier: {}", "License: {}", "Licence: {}", "Licensing: {}", "Lizenz: {}", "Licencia: {}", "Publié sous licence {}.", "Licensed under {}.", "Licensed under the {}.", "Licensed under a {}.",
    "This work is licensed under the {}.", "This software is licensed under the terms of the {}.", "Released under {}.", "Released under the {}.", "Distributed under the {}.", "Code available under {}.",
    "Available under the terms of the {}.", "The code is {} licensed.", "This project uses the {}.", "You may use this file under the {}.", "Subject to the {}.", "{}", "{} - see LICENSE.", "Copyright (c) 2019 Jane Doe. {}.",
    "This file is made available under the {}.", "It is offered under {}.", "The package falls under the {} as given below.",
)
HELD_SAYINGS = 3
#: Features of fewer examples have no weight, and weights below this are dropped and the others fitted again.
LEAST_SEEN, LEAST_WEIGHT = 6, 0.12
# Licenses that are none of the families, and what has words of notices and is no notice.
OTHER_NAMES = (
    "Acme Software License 1.2", "Foo Public License", "Foo Public License version 3", "Bar License 2.0", "Example Community License", "Sleepycat License", "Oracle Technology Network License", "Vendor End User License Agreement",
    "Open Data License 1.0", "NASA Open Source Agreement", "Server Side Public License", "Elastic License 2.0", "Llama Community License", "Business Source License 1.1", "company's own terms", "terms of a driving license", "old name",
    "General License", "Lesser License", "Public License", "Free License", "Open License 4.0", "Software Agreement, version 2.0", "author", "guidance of the director", "name of Apache county",
)
OTHERS = (
    "The driver showed a license at the gate.", "A new license fee applies to restaurants in the city.", "All seats are reserved for members.", "She asked for permission to leave early.",
    "Human rights were discussed at the public meeting.", "The general public is invited to the hall.", "He copied the terms of the contract by hand.", "The source of the river was found by the foundation.",
    "Free coffee is granted to every person who comes.", "The version of the story that was published differs.", "They granted the right of way and reserved a table.", "The students of MIT and the people of Apache county met.",
    "MIT opened a laboratory.", "A professor at MIT spoke about zero.", "The attribution of the painting is not certain.", "The commons was open to all, in the domain of the king.", "The book was released under the title of the first part.",
    "He went to the house of the man and was told that it is for the use of all or of none.", "Er kam mit der Bahn und ging mit ihr nach Hause.", "Mit dem Auto, mit Freunden, mit Geduld.", "Apache helicopters landed at the base.",
    "The eclipse was seen by the public.", "Mozilla released a new browser.", "The Python foundation held a meeting.", "European Union law is public.", "A BSD system was installed.", "The GNU project was founded in 1983.", "ISC met in June.",
    "The boost in sales was noted.", "An artistic school opened.", "This software is provided to customers by mail.", "No rights were violated.", "The copyright notice was missing.", "Copyright (c) 2019 Jane Doe.", "See LICENSE.",
    "The public domain of the town is small.", "He wrote on the law of the public domain.", "Do what you want to.", "A copy of the permission is kept in the file.", "Without limitation of the above, the parties agree to the following conditions.",
)
# Words that alone say nothing. N-grams of these, of numbers and of words of two letters alone are no features.
STOP = frozenset("a all an and any are as at be been by can das de der die do el for from has have he in into is it la le les new no not of on only or she that the their they this to under was we were what which who will with work you your mit".split())


def words_of(text: str) -> list[str]:
    return re.findall(r"[A-Za-z0-9]+", text)


def says_nothing(word: str) -> bool:
    return word in STOP or len(word) <= 2 or word.isdigit()


def grams_of(words: list[str]) -> set[str]:
    """The features of words: n-grams in lower case that say something, and each word in capitals as such."""
    low = [w.lower() for w in words]
    grams = {" ".join(g) for n in NGRAMS for i in range(len(low) - n + 1) if not all(map(says_nothing, g := low[i : i + n]))}
    return grams | {f"={w}" for w in words if re.fullmatch(r"[A-Z][A-Z0-9]+", w)}


def templates() -> list[tuple[str, str, set[str]]]:
    """(template, family, features): the texts, and the names but for those that are plain words."""
    said = {family: [*(n for n in NAMES[family] if n != n.lower()), *TEXTS.get(family, ())] for family in sorted(NAMES)}
    return [(f"{family}/{i}", family, grams_of(words_of(t))) for family, texts in said.items() for i, t in enumerate(texts)]


def examples(seed: int) -> list[tuple[set[str], int, bool]]:
    """(features, class, held): names in sayings, texts whole and in part, and for the unknown class other names and talk."""
    rng = random.Random(seed)
    classes = (*sorted(NAMES), UNKNOWN)
    filler = words_of(" ".join(OTHERS))
    out: list[tuple[set[str], int, bool]] = []

    def put(text: str, y: int, held: bool = False) -> None:
        words = words_of(text)
        around = lambda: [rng.choice(filler) for _ in range(rng.choice((0, 0, 2, 5)))]
        out.append((grams_of(around() + words + around()), y, held))

    for y, family in enumerate(classes):
        for name in NAMES.get(family, OTHER_NAMES):
            for k, saying in enumerate(SAYINGS):
                put(saying.format(name), y, k >= len(SAYINGS) - HELD_SAYINGS)
        for text in TEXTS.get(family, ()) if family != UNKNOWN else OTHERS:
            words = words_of(text)
            for k in range(16):
                lo = rng.randrange(max(1, len(words) // 3)) if k % 2 else 0
                put(" ".join(w for w in words[lo:] if rng.random() > 0.04 * (k % 3)), y, k % 8 == 7)
    unknown, heard = len(classes) - 1, [s.format("") for s in SAYINGS]
    for k in range(600):  # talk of words of notices in any order
        talk = [rng.choice(filler) for _ in range(rng.randrange(3, 14))] + (words_of(rng.choice(heard)) if k % 2 else [])
        rng.shuffle(talk)
        out.append((grams_of(talk), unknown, k % 8 == 7))
    return out + [(set(), unknown, False)] * 30


@functools.cache
def train(seed: int = 3, rounds: int = 36, rate: float = 0.5, sparse: float = 4e-3) -> tuple[tuple[str, ...], dict[str, list[float]], list[float]]:
    """(classes, weights by feature, bias): softmax regression by seeded, scaled gradient steps.

    Two thirds of the rounds have an L1 penalty, which leaves most features without a weight; the rest fit what is left.
    The temperature is set on held-out sayings. The last class is the unknown one.
    """
    rng, rows = random.Random(seed), examples(seed)
    classes = (*sorted(NAMES), UNKNOWN)
    seen = Counter(g for x, _, held in rows if not held for g in x)
    names = sorted(g for g, n in seen.items() if n >= LEAST_SEEN)
    number = {g: i for i, g in enumerate(names)}
    placed = [(np.array(sorted(number[g] for g in x if g in number), int), y, held) for x, y, held in rows]
    weights, bias = np.zeros((len(names), len(classes))), np.zeros(len(classes))
    sums, bias_sums = np.full(len(names), 1e-3), 1e-3
    fitted = [(x, y) for x, y, held in placed if not held]
    chosen = np.ones(weights.shape, bool)
    for t in range(rounds):
        if t == 2 * rounds // 3:
            chosen, sparse = np.abs(weights) >= LEAST_WEIGHT, 0.0
            weights *= chosen
        rng.shuffle(fitted)
        for x, y in fitted:
            z = bias + weights[x].sum(0)
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            size = float(p @ p)
            bias_sums += size
            bias -= rate / math.sqrt(bias_sums) * p
            if len(x):
                sums[x] += size
                step = (rate / np.sqrt(sums[x]) / math.sqrt(len(x)))[:, None]
                moved = weights[x] - step * p
                weights[x] = np.sign(moved) * np.maximum(np.abs(moved) - sparse * step, 0) * chosen[x]
    logits = [((bias + weights[x].sum(0)), y) for x, y, held in placed if held]
    best = min((t / 20 for t in range(4, 61)), key=lambda t: -sum(math.log(max(1e-12, softmax((z / t).tolist())[y])) for z, y in logits))
    return classes, {g: w for g, w in zip(names, (weights / best).round(6).tolist(), strict=True) if any(w)}, (bias / best).tolist()


def softmax(z: list[float]) -> list[float]:
    top = max(z)
    e = [math.exp(v - top) for v in z]
    return [v / sum(e) for v in e]


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out once."""
    return F.transform(F.array(value), f)[0]


def _words(text: Column) -> Column:
    """The words in lower case."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def _cell(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(CELLS)).cast("int")


class Model:
    """What the scan needs of the trained weights, as columns and tables of fixed size."""

    def __init__(self, spark: SparkSession):
        self.classes, self.weights, self.bias = train()
        self.templates = templates()
        self.vocabulary = sorted({w for g in (*self.weights, *(g for _, _, x in self.templates for g in x)) if g[0] != "=" for w in g.split(" ")})
        gains = {g: [max(0.0, v - w[-1]) for v in w[:-1]] for g, w in self.weights.items()}
        gains = {g: x for g, x in gains.items() if any(x)}
        #: What the gains of a part must exceed, in one class, for a family to be likelier than the unknown class.
        self.least = self.bias[-1] - max(self.bias[:-1]) - 1e-6
        # Every feature with a gain has one of these words, or is one of these in capitals: without them nothing can be named.
        alone = lambda w: (max(gains.get(w, [0.0])), len(w), w)
        self.cues = sorted({max((w for w in g.split(" ") if not says_nothing(w)), key=alone) for g in gains if g[0] != "="})
        self.capitals = sorted(g[1:] for g in gains if g[0] == "=")
        self.known_capitals = sorted({g[1:] for g in (*self.weights, *(g for _, _, x in self.templates for g in x)) if g[0] == "="})
        self._cells, self._rows = [0.0] * CELLS, [[] for _ in range(CELLS)]
        for g, cell in spark.createDataFrame([(g,) for g in gains], "g string").select("g", F.pmod(F.xxhash64("g"), F.lit(CELLS))).collect():
            self._cells[cell] = max(self._cells[cell], *gains[g])
            self._rows[cell] = [max(x) for x in zip(self._rows[cell] or gains[g], gains[g], strict=True)]

    def maybe_cued(self, text: Column) -> Column:
        """No more than cued asks for, at less cost: capitals do not count."""
        some = sorted({*self.cues, *(w.lower() for w in self.capitals)})
        return F.exists(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w.isin(some))

    def cued(self, text: Column) -> Column:
        """By patterns that part the words by their first letters: most places of a text fail at once."""
        first = sorted({w[0] for w in self.cues})
        some = "|".join(f"{c}(?:{'|'.join(w[1:] for w in self.cues if w[0] == c)})" for c in first)
        whole = lambda pattern: f"(?<![A-Za-z0-9])(?:{pattern})(?![A-Za-z0-9])"
        return F.lower(text).rlike(whole(some)) | text.rlike(whole("|".join(self.capitals)))

    def said_in_capitals(self, text: Column) -> Column:
        return F.filter(F.split(text, "[^A-Za-z0-9]+"), lambda w: w.isin(self.known_capitals))

    def grams(self, low: Column, capitals: Column) -> Column:
        """As grams_of, of words in lower case and others in capitals, those of words of the vocabulary; and first an empty one, which stands for the text itself."""
        known = lambda low, i: F.get(low, i).isin(self.vocabulary)
        gram = lambda low, i, n: F.concat_ws(" ", *[F.get(low, i + j) for j in range(n)])
        grams = lambda low, at: F.flatten(F.array(*[F.transform(at[n - 1], lambda i: gram(low, i, n)) for n in NGRAMS]))

        def of_words(low: Column) -> Column:
            one = F.filter(F.sequence(F.lit(0), F.size(low)), lambda i: known(low, i))
            return _let(one, lambda a: _let(F.filter(a, lambda i: known(low, i + 1)), lambda b: grams(low, [a, b, F.filter(b, lambda i: known(low, i + 2))])))

        return F.array_distinct(F.concat(F.array(F.lit("")), F.transform(capitals, lambda w: F.concat(F.lit("="), w)), _let(low, of_words)))

    def grams_of(self, text: Column) -> Column:
        return self.grams(_words(text), self.said_in_capitals(text))

    def bound(self, grams: Column) -> Column:
        """At least the sum of the gains of features, in any class. Gains are looked up by hash; of those in one cell the largest count."""
        table = F.from_json(F.lit(json.dumps(self._cells)), "array<double>")
        return F.aggregate(grams, F.lit(0.0), lambda acc, g: acc + F.get(table, _cell(g)))

    def bounds(self, grams: Column) -> Column:
        """The same by class, as an array."""
        table, none = F.from_json(F.lit(json.dumps(self._rows)), "array<array<double>>"), F.array(*[F.lit(0.0)] * (len(self.classes) - 1))
        some = F.filter(F.transform(grams, lambda g: F.get(table, _cell(g))), lambda x: F.size(x) > 0)
        return F.aggregate(some, none, lambda acc, x: F.zip_with(acc, x, lambda a, b: a + b))

    def hopeful(self, bounds: Column) -> Column:
        """Whether bounds leave it open that some class is likelier than the unknown one."""
        least = F.array(*[F.lit(self.bias[-1] - b - 1e-6) for b in self.bias[:-1]])
        return F.exists(F.zip_with(bounds, least, lambda a, b: a > b), lambda x: x)

    def score(self, parts: DataFrame, key: list[str]) -> DataFrame:
        """For each key best, probability, templates met (one for each feature) and copies, the number of equal rows."""
        zero, columns = [0.0] * len(self.classes), [f"w{c}" for c in range(len(self.classes))]
        known = {"", *self.weights}.union(*(x for _, _, x in self.templates))
        rows = [(g, *self.weights.get(g, zero), [n for n, _, x in self.templates if g in x]) for g in sorted(known)]
        table = parts.sparkSession.createDataFrame(rows, ", ".join(["gram string", *[f"{c} double" for c in columns], "templates array<string>"]))
        copies = F.count_if(F.col("gram") == "")
        met = parts.select(*key, F.explode(self.grams_of(F.col("text"))).alias("gram")).join(F.broadcast(table), "gram")
        logits = F.array(*[F.lit(b) + F.sum(c) / copies for c, b in zip(columns, self.bias, strict=True)])
        total = lambda z, top: F.aggregate(z, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
        best = lambda z, top: F.element_at(F.array(*map(F.lit, self.classes)), F.array_position(z, top).cast("int"))
        verdict = _let(F.col("z"), lambda z: _let(F.array_max(z), lambda top: F.struct(best(z, top).alias("best"), (1 / total(z, top)).alias("probability"))))
        found = met.groupBy(*key).agg(logits.alias("z"), F.flatten(F.collect_list("templates")).alias("hits"), copies.alias("copies"))  # of one part
        return found.withColumn("verdict", verdict).select(*key, "verdict.*", "hits", "copies")

    def similarity(self) -> Column:
        """The largest share of a template of the best family that is in hits."""
        own = F.create_map(*[x for name in sorted(NAMES) for x in (F.lit(name), F.array(*[F.lit(n) for n, of, _ in self.templates if of == name]))])
        count = F.create_map(*[F.lit(x) for n, _, x in self.templates for x in (n, float(len(x)))])
        share = F.transform(own[F.col("best")], lambda n: F.size(F.filter("hits", lambda h: h == n)) / F.col("copies") / count[n])
        return F.round(F.coalesce(F.array_max(share), F.lit(0.0)), 6)


def _paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, of (a hash of the text), paragraph (the number of its first line) and its lines."""
    text = docs.select("doc_id", text_of(docs).alias("text"))
    at = lambda xs, i: F.coalesce(F.get(xs, i), F.lit(False))
    numbers = lambda xs: F.sequence(F.lit(0), F.size(xs))
    first = lambda said: F.filter(numbers(said), lambda i: at(said, i) & ~at(said, i - 1))
    last = lambda said: F.filter(numbers(said), lambda i: at(said, i) & ~at(said, i + 1))
    spans = _let(F.transform("lines", lambda x: x.rlike(_SAID)), lambda said: F.arrays_zip(first(said).alias("first"), last(said).alias("last")))
    lined = text.select("doc_id", F.xxhash64("text").alias("of"), F.split("text", "\n").alias("lines"))
    found = lined.select("doc_id", "of", "lines", F.explode(spans).alias("x"))
    return found.select("doc_id", "of", F.col("x.first").alias("paragraph"), F.slice("lines", F.col("x.first") + 1, F.col("x.last") - F.col("x.first") + 1).alias("lines"))


def _parts(paragraphs: DataFrame, model: Model) -> DataFrame:
    """The parts of each paragraph where a notice may stand: the paragraph, its pieces, and runs of pieces of up to RUN_WORDS words.

    Pieces are lines; a line of more than RUN_WORDS words is cut at the ends of its sentences. Runs begin and end with a
    piece that has a gain. Left out are pieces and runs whose gains are below the least: none of them can be named.
    """
    short = lambda x: F.size(_words(x)) <= RUN_WORDS
    cut_up = lambda x: F.when(short(x), F.array(x)).otherwise(F.split(x, r"(?<=[.!?;:])\s+"))
    piece = lambda i, y: F.struct(i.alias("line"), y.alias("text"), _words(y).alias("words"), model.said_in_capitals(y).alias("capitals"))
    pieces = F.flatten(F.transform("lines", lambda x, i: F.transform(cut_up(x), lambda y: piece(i, y))))
    pieces = F.filter(pieces, lambda x: F.size(x["words"]) > 0)
    # Grams may reach into the next pieces: they are counted where they begin.
    reach = lambda xs, i: F.concat(xs[i]["words"], F.slice(F.flatten(F.transform(F.slice(xs, i + 2, 2), lambda x: x["words"])), 1, max(NGRAMS) - 1))
    told = _let(pieces, lambda xs: F.transform(xs, lambda x, i: F.struct(x["line"].alias("line"), x["text"].alias("text"), F.size(x["words"]).alias("n"), model.bounds(model.grams(reach(xs, i), x["capitals"])).alias("gain"))))
    step = lambda acc, x: F.struct((acc["sum"] + x["n"]).alias("sum"), F.when(acc["sum"] + x["n"] <= RUN_WORDS, acc["k"] + 1).otherwise(acc["k"]).alias("k"))
    longest = lambda xs, i: F.aggregate(F.slice(xs, i + 1, RUN_WORDS), F.struct(F.lit(0).alias("sum"), F.lit(0).alias("k")), step)["k"]
    part = lambda xs, i, k: F.struct(xs[i]["line"].alias("line"), i.alias("at"), k.alias("k"), F.array_join(F.transform(F.slice(xs, i + 1, k), lambda x: x["text"]), " ").alias("text"))
    some = lambda x: F.array_max(x["gain"]) > 0
    sums = lambda xs, i, n: F.aggregate(F.slice(xs, i + 1, n), F.array().cast("array<array<double>>"), lambda acc, x: F.concat(acc, F.array(F.when(F.size(acc) == 0, x["gain"]).otherwise(F.zip_with(F.element_at(acc, F.size(acc)), x["gain"], lambda a, b: a + b)))))
    ends = lambda xs, i: _let(sums(xs, i, F.greatest(longest(xs, i), F.lit(1))), lambda g: F.filter(F.sequence(F.lit(1), F.size(g)), lambda k: some(xs[i + k - 1]) & model.hopeful(g[k - 1])))
    starts = lambda xs: F.filter(F.sequence(F.lit(0), F.size(xs) - 1), lambda i: some(xs[i]))
    runs = lambda xs: F.flatten(F.transform(starts(xs), lambda i: F.transform(ends(xs, i), lambda k: part(xs, i, k))))
    return paragraphs.select(*_KEY, F.explode(_let(told, lambda xs: F.when(F.size(xs) > 0, F.concat(F.array(part(xs, F.lit(0), F.size(xs))), runs(xs))))).alias("x")).select(*_KEY, "x.*")


def _apart(parts: Column) -> Column:
    """Of parts in order of preference those that meet none before; only confirmed ones besides the first."""
    meets = lambda a, b: (a["at"] < b["at"] + b["k"]) & (b["at"] < a["at"] + a["k"])
    taken = lambda acc, x: F.when((F.size(acc) == 0) | x["confirmed"] & ~F.exists(acc, lambda y: meets(x, y)), F.concat(acc, F.array(x))).otherwise(acc)
    return F.aggregate(parts, F.slice(parts, 1, 0), taken)


def scan_licenses(docs: DataFrame, least_probability: float = LEAST_PROBABILITY, least_similarity: float = LEAST_SIMILARITY) -> DataFrame:
    """doc_id, paragraph, family, probability, similarity, confirmed: the notices of each paragraph, or one row `unknown`.

    Paragraphs are parted by lines without letters and digits; the breaks between their lines count as blanks, so a notice
    may be wrapped anywhere. Notices are looked for in the parts of a paragraph (see _parts), since several can stand in one
    and other words around them; of parts that meet, the one most like a template counts, then the shortest. A paragraph has
    a row for each confirmed notice, else for its best named part, else one `unknown` row for the whole of it. `paragraph`
    is the line at which the notice's part, or else the paragraph, begins, counted from 0. Paragraphs whose features
    together could name no family have no row: those are of the unknown class whatever the rest of them says.

    `family` is the most likely one, or `unknown` if that is likelier or the probability is too low. `similarity` is the
    largest share of a template of that family that the part has, and confirms it.

    Nulls: a null text has no paragraphs. Of equal probabilities the class first by name counts. Equal rows give equal rows
    once: a document is known by doc_id and text. Empty tables, and texts without letters and digits, give no rows; other
    columns are left aside. Texts of any length are scanned whole.
    """
    model = Model(docs.sparkSession)
    cued = _paragraphs(docs.where(model.cued(text_of(docs)))).withColumn("text", F.array_join("lines", " "))
    open_ = lambda grams: F.when(model.bound(grams) > model.least, model.hopeful(model.bounds(grams))).otherwise(F.lit(False))
    hopeful = cued.where(model.cued(F.col("text"))).where(_let(model.grams_of(F.col("text")), open_))
    scored = model.score(_parts(hopeful.select(*_KEY, "lines"), model), [*_KEY, "line", "at", "k"])
    named = (F.col("best") != UNKNOWN) & (F.col("probability") >= least_probability)
    similar = scored.withColumn("similarity", F.when(named, model.similarity()).otherwise(F.lit(0.0))).withColumn("named", named)
    rest = [F.col("line"), F.when(named, F.col("best")).otherwise(F.lit(UNKNOWN)).alias("family"), "probability", "similarity", (F.col("named") & (F.col("similarity") >= least_similarity)).alias("confirmed")]
    # What is not named comes last, the longest first: that is the paragraph itself.
    order = F.struct((~F.col("named")).alias("last"), (-F.col("similarity")).alias("rank"), F.when(named, F.col("k")).otherwise(-F.col("k")).alias("size"), (-F.col("probability")).alias("second"), "at", "k", *rest)
    found = similar.groupBy(*_KEY).agg(_apart(F.array_sort(F.collect_list(order))).alias("found"))  # of one paragraph
    out = found.select("doc_id", "paragraph", F.explode("found").alias("x"))
    return out.select("doc_id", (F.col("paragraph") + F.col("x.line")).cast("long").alias("paragraph"), "x.family", F.round("x.probability", 6).alias("probability"), "x.similarity", "x.confirmed")
