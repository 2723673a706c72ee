"""Licence scans: a trained paragraph classifier whose predictions a template comparison confirms.

A multinomial logistic regression over word 1- and 2-grams gives each paragraph licence
families or `unknown`; its probabilities are calibrated on held-out paragraphs. A predicted
family is reported where a template of that family is found in the paragraph.

A paragraph is a run of lines that hold words, whatever marks a comment puts before them.
A null or empty text has none; repeated rows are scanned alike; a paragraph of any length is
read whole, window by window. Two families that fit the same words equally well, as in a dual
licence, are both reported; of unequal ones the better fit is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelens.llm.decontamination import words

UNKNOWN = "unknown"

#: Notices by which public licences are commonly declared, by family.
TEMPLATES = {
    "agpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "Licensed under the GNU Affero General Public License, version 3.",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD License.",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "cc0": ["To the extent possible under law, the author has waived all copyright and related rights to this work.", "Dedicated to the public domain under CC0 1.0."],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Licensed under the GPL version 2 or later.",
    ],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "Released under the ISC License."],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at",
        "Licensed under the Mozilla Public License 2.0.",
    ],
}
#: Notices that leave the choice between families.
DUAL = {
    ("apache", "mit"): [
        "Licensed under either of Apache License, Version 2.0 or MIT license at your option.",
        "Licensed under either MIT or Apache 2.0.",
        "Dual licensed under the MIT and Apache 2.0 licenses.",
    ],
    ("gpl", "mit"): ["Dual licensed under the MIT or GPL Version 2 licenses.", "Dual licensed under the MIT and GPL licenses."],
}

#: Paragraphs without a licence that the classifier is trained on, at most; from a sample by hash.
NEGATIVES = 4_000
#: Generated paragraphs for each template.
VARIANTS = 40
#: Longer paragraphs are read in windows of so many words, which overlap by half.
WINDOW = 80
LEAST_PROBABILITY = 0.5
#: Families from this probability on are compared with their templates, unless `unknown` reaches LEAST_PROBABILITY.
COMPARED_PROBABILITY = 0.15
#: Part of a template's word pairs that must stand in a run of at most twice its words.
CONFIRMING = 0.6
#: Words that some languages put before each line of a comment.
LINE_MARKS = (b"rem", b"dnl")

RESULT = (
    "doc_id long, n_paragraphs long, n_licences long, n_unconfirmed long, families string, spans string, probability double"
)


def grams(found: list[bytes]) -> list[bytes]:
    return found + [a + b" " + b for a, b in zip(found, found[1:])]


def pairs(found: list[bytes]) -> frozenset[tuple[bytes, bytes]]:
    return frozenset(zip(found, found[1:]))


NOTICES = {f: texts + [t for fs, more in DUAL.items() if f in fs for t in more] for f, texts in TEMPLATES.items()}
TEMPLATE_PAIRS = {f: [pairs(words(t.encode())) for t in texts] for f, texts in NOTICES.items()}


def likeness(found: list[bytes], family: str) -> float:
    """The largest part of a template's word pairs that the words hold."""
    have = pairs(found)
    return max(len(t & have) / len(t) for t in TEMPLATE_PAIRS[family])


def best_run(found: list[bytes], family: str) -> tuple[float, int, int]:
    """Likeness, first and last word of the run that is most like a template, the shortest of equals."""
    best = (0.0, 0, 0)
    for template in TEMPLATE_PAIRS[family]:
        hits = [(i, pair) for i, pair in enumerate(zip(found, found[1:])) if pair in template]
        for n, (first, _) in enumerate(hits):
            seen = set()
            for last, pair in hits[n:]:
                if last + 1 - first > 2 * len(template):
                    break
                if pair not in seen:
                    seen.add(pair)
                    fit = len(seen) / len(template)
                    if (fit, first - last) > (best[0], best[1] - best[2] + 1):
                        best = (fit, first, last + 1)
    return best


@dataclass(frozen=True)
class Classifier:
    """Weights by gram (a row for each class, UNKNOWN first), weights for length, and the temperature."""

    classes: tuple[str, ...]
    weights: dict[bytes, object]
    bias: object
    temperature: float

    def probabilities(self, found: list[bytes]):
        import numpy as np

        score = self.bias.astype(np.float64)
        for w in [self.weights[g] for g in {g: None for g in grams(found)} if g in self.weights]:
            score = score + w
        score = score / self.temperature
        p = np.exp(score - score.max())
        return p / p.sum()

    def cues(self) -> frozenset[bytes]:
        """Words of which a window must hold one to be anything but unknown.

        Without a gram that speaks for a family more than for UNKNOWN, no family can
        exceed the bias, which is in favour of UNKNOWN.
        """
        import numpy as np

        ahead = [g for g, w in self.weights.items() if (np.asarray(w)[1:] > w[0]).any()]
        return frozenset(word for g in ahead for word in g.split(b" ")[-1:])


def design(examples: list[list[bytes]], place: dict[bytes, int]):
    import numpy as np

    x = np.zeros((len(examples), len(place)), np.float32)
    for i, found in enumerate(examples):
        for g in {g: None for g in grams(found)}:
            if g in place:
                x[i, place[g]] = 1
    return x


def train(negatives: list[list[bytes]]) -> Classifier:
    """Fits on templates, varied and set among other words, and on paragraphs without a licence.

    Full-batch gradient descent with an L2 penalty, then one temperature chosen on a
    fifth of the examples that the weights have not seen.
    """
    import numpy as np

    random = np.random.default_rng(11)
    classes = (UNKNOWN, *TEMPLATES)
    examples, targets = [], []
    plain = [n for n in negatives if n]
    for c, texts in enumerate(NOTICES.values(), 1):
        for text in texts:
            template = words(text.encode())
            for v in range(VARIANTS):
                kept = [w for w in template if v < 4 or random.random() > 0.1] or template
                around = plain[random.integers(len(plain))][: random.integers(0, WINDOW - 10)] if plain and v % 4 else []
                cut = int(random.integers(0, len(around) + 1))
                examples.append(around[:cut] + kept + around[cut:])
                targets.append(c)
    for found in plain:
        examples.append(found[:WINDOW])
        targets.append(0)
    examples += [[]] * 50
    targets += [0] * 50
    order = random.permutation(len(examples))
    held = order[: len(order) // 5]
    fitted = order[len(order) // 5 :]
    seen: dict[bytes, int] = {}
    for i in fitted:
        for g in {g: None for g in grams(examples[i])}:
            seen[g] = seen.get(g, 0) + 1
    place = {g: i for i, g in enumerate(sorted(g for g, n in seen.items() if n >= 8))}
    y = np.eye(len(classes), dtype=np.float32)[np.array(targets)]
    x = design([examples[i] for i in fitted], place)
    w, b = np.zeros((len(place), len(classes)), np.float32), np.zeros(len(classes), np.float32)
    for _ in range(300):
        z = x @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        e = (p - y[fitted]) / len(fitted)
        w -= 4.0 * (x.T @ e + 1e-4 * w)
        b -= 4.0 * e.sum(axis=0)
    w[np.abs(w) < 0.05] = 0
    b[1:] = np.minimum(b[1:], b[0] - 0.5)  # no words at all are unknown
    z = design([examples[i] for i in held], place) @ w + b

    def loss(t):
        s = z / t
        s = s - s.max(axis=1, keepdims=True)
        return -(s - np.log(np.exp(s).sum(axis=1, keepdims=True)))[np.arange(len(held)), np.array(targets)[held]].mean()

    temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0), key=loss)
    return Classifier(classes, {g: w[i] for g, i in place.items() if w[i].any()}, b, float(temperature))


def sample_negatives(docs: DataFrame, key: str, text: str) -> list[list[bytes]]:
    """Words of paragraphs that hold no template, from about NEGATIVES / 4 documents chosen by the hash of their key.

    The paragraphs are taken in the order of their hash, so the sample does not depend on how the rows lie in files.
    """
    total = max(docs.count(), 1)
    cells = 1 << 40
    part = min(1.0, NEGATIVES / 4 / total)
    chosen = docs.where(F.pmod(F.xxhash64(F.col(key)), F.lit(cells)) < max(1, int(part * cells)))
    # The start of each line is enough to learn what ordinary words look like.
    lines = chosen.select(F.explode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("p")).select(
        F.substring("p", 1, 1000).alias("p")
    )
    found = [words(r["p"].encode()) for r in lines.orderBy(F.xxhash64("p"), "p").limit(NEGATIVES).collect()]
    return [f for f in found if all(likeness(f, family) < 0.4 for family in TEMPLATES)]


def windows(found: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    for at in range(0, max(1, len(found) - WINDOW // 2), WINDOW // 2):
        yield at, found[at : at + WINDOW]


def strongest(matches: list[tuple[int, int, float, str, float]]) -> list[tuple[int, int, float, str, float]]:
    """Matches (first word, last word, likeness, ..) that no more alike one overlaps; runs are at most a window long."""
    matches = sorted(set(matches))
    kept = []
    for n, match in enumerate(matches):
        beaten = False
        for step in (-1, 1):
            m = n + step
            while 0 <= m < len(matches) and not beaten and abs(matches[m][0] - match[0]) <= WINDOW:
                other = matches[m]
                beaten = other[2] > match[2] and other[0] <= match[1] and match[0] <= other[1]
                m += step
        if not beaten:
            kept.append(match)
    return kept


def classify(model: Classifier, found: list[bytes], cues: frozenset[bytes]):
    """Confirmed matches (first word, last word, likeness, family, probability), and families that stay unconfirmed.

    Words of a confirmed notice are blanked and the rest of the window is classified again, until
    nothing more is confirmed; so each of several notices in a window is found. A prediction is
    unconfirmed only in a window beside which nothing is confirmed: the rest of a notice resembles others.
    """
    matches, predicted, step = [], [], WINDOW // 2
    for at, window in windows(found):
        left = list(window)
        while not cues.isdisjoint(left):
            p = model.probabilities(left)
            if p[0] >= LEAST_PROBABILITY:
                break
            of = dict(zip(model.classes, p.tolist()))
            families = [(family, of[family]) for family in TEMPLATES if of[family] >= COMPARED_PROBABILITY]
            runs = [(best_run(left, family), family, q) for family, q in families]
            # A notice that leaves the choice declares all its families, to whichever of them the model leans.
            runs += [
                (run, other, of[other])
                for run, family, _ in runs
                for other in sorted({f for fs in DUAL if family in fs for f in fs})
                if of[other] < COMPARED_PROBABILITY and best_run(left, other) == run
            ]
            here = strongest([(a, b, fit, family, q) for (fit, a, b), family, q in runs if fit >= CONFIRMING])
            if not here:
                predicted += [(at, family) for family, q in families if q >= LEAST_PROBABILITY]
                break
            for a, b, fit, family, q in here:
                matches.append((at + a, at + b, fit, family, q))
                left[a : b + 1] = [b""] * (b + 1 - a)
    matches = strongest(matches)
    touched = {w for a, b, *_ in matches for w in range(a // step * step - step, b + step + 1, step)}
    return matches, {family for at, family in predicted if at not in touched}


def paragraphs(lines: list[bytes]) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Runs of lines that hold words: (line, its words without a comment's mark)."""
    run: list[tuple[int, list[bytes]]] = []
    for n, line in enumerate(lines):
        found = words(line)
        if found and found[0] in LINE_MARKS:
            found = found[1:]
        if found:
            run.append((n, found))
        elif run:
            yield run
            run = []
    if run:
        yield run


def scan_text(model: Classifier, cues: frozenset[bytes], data: bytes):
    """(paragraphs, spans (start, end, family) of confirmed licences, unconfirmed, highest probability).

    A span covers whole lines, in code points; touching spans of a family in a paragraph are one.
    """
    lines = data.split(b"\n")
    n, spans, unconfirmed, top, starts = 0, [], 0, None, None
    for paragraph in paragraphs(lines):
        n += 1
        found = [w for _, line in paragraph for w in line]
        if cues.isdisjoint(found):
            continue
        matches, predicted = classify(model, found, cues)
        unconfirmed += len(predicted)
        if not matches:
            continue
        if starts is None:
            starts = [0]
            for line in lines:
                starts.append(starts[-1] + len(line.decode("utf-8", "replace")) + 1)
        place = [line for line, ws in paragraph for _ in ws]
        joined: dict[str, list[list[int]]] = {}
        for a, b, _, family, q in matches:
            top = max(top or 0.0, q)
            mine = joined.setdefault(family, [])
            if mine and place[a] <= mine[-1][1]:
                mine[-1][1] = max(mine[-1][1], place[b])
            else:
                mine.append([place[a], place[b]])
        spans += sorted((starts[a], starts[b + 1] - 1, family) for family, mine in joined.items() for a, b in mine)
    return n, spans, unconfirmed, top


def scanner(model: Classifier):
    import pyarrow as pa

    cues = model.cues()

    def run(batches):
        for batch in batches:
            rows = []
            for data in batch.column("text").cast(pa.binary()).to_pylist():
                n, spans, unconfirmed, top = scan_text(model, cues, data or b"")
                families = ",".join(sorted({s[2] for s in spans}))
                rows.append((n, len(spans), unconfirmed, families, ",".join(f"{f}:{a}:{b}" for a, b, f in spans), top))
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                names=["doc_id", "n_paragraphs", "n_licences", "n_unconfirmed", "families", "spans", "probability"],
            )

    return run


def scan(docs: DataFrame, key: str, text: str, model: Classifier | None = None) -> DataFrame:
    """One row per document row: confirmed licence paragraphs, their families and places in code points; no shuffle.

    A null or empty text has no paragraphs. Without a model one is trained on the rows given.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    model = model or train(sample_negatives(rows, "doc_id", "text"))
    return rows.mapInArrow(scanner(model), RESULT)


def op1_licence_scan(spark, sf_dir: str) -> DataFrame:
    """Licences declared in all documents."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
