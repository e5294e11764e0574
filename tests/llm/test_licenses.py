import math
import random
import re

from linetally.llm.licenses import PHRASES, TEMPLATES, THRESHOLD, license_scan

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text):
    return [w.decode() for w in re.findall(rb"[0-9a-z\x80-\xff]+", text.encode().translate(LOWER))]


def brute_force(text):
    w = words_of(text or "")
    places, base, blocks = [], set(), []
    for phrase, label in PHRASES:
        p = phrase.split()
        for i in range(len(w)):
            if w[i : i + len(p)] == p:
                places.append(i)
                base.add(label)
    at = 0
    for line in (text or "").split("\n"):
        own = words_of(line)
        for template, label in TEMPLATES:
            need = set(template.split())
            if len(need & set(own)) >= math.ceil(THRESHOLD * len(need) - 1e-9):
                blocks.append((label, at, at + len(own) - 1, len(need & set(own)) / len(need)))
        at += len(own)
    labels = base | {b[0] for b in blocks}
    score = max([1.0 * bool(base), *(b[3] for b in blocks)])
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score, sorted(blocks))


def test_same_as_brute_force(frame, edge):
    texts = [t for t, _ in TEMPLATES] + [
        "Licensed under CC BY-NC 4.0.\nMIT License, the mit-license and (MIT) LICENSE",
        "under the Apache\nLicense", "GNU General Public License v3", "gnu general public", "commit license mit licenses",
        "Permission is hereby granted, free of charge, to any person getting a copy of THIS software\nand more",
        "permission is hereby granted", "éMIT License", "mit", "license", "x " * 4000 + "mit license " + "y\n" * 10,
    ]
    rows = edge + [(1000 + i, t) for i, t in enumerate(texts)]
    got = license_scan(frame(rows)).collect()
    found = lambda r: (r["doc_id"], *tuple(r)[1:8], sorted(tuple(b) for b in r["blocks"]))
    assert sorted(map(found, got), key=str) == sorted(((i, *brute_force(t)) for i, t in rows), key=str)


def test_words_do_not_run_over_texts(frame):
    rows = [(1, "mit"), (2, "license"), (3, "mi"), (4, "t license")]
    assert all(r["n_base"] == 0 for r in license_scan(frame(rows)).collect())


def test_empty(frame):
    assert license_scan(frame([])).count() == 0


def by_lines(text):
    """Every run of lines with words that meets a template while no shorter run inside it does."""
    found, lines = [], [words_of(x) for x in (text or "").split("\n")]
    for template, label in TEMPLATES:
        need = set(template.split())
        least = math.ceil(THRESHOLD * len(need) - 1e-9)
        met = {
            (i, j): len(need.intersection(sum(lines[i : j + 1], []))) for i in range(len(lines)) for j in range(i, len(lines)) if all(lines[i : j + 1])
        }
        met = {k: n for k, n in met.items() if n >= least}
        for (i, j), n in met.items():
            if not any(i <= k and m <= j and (k, m) != (i, j) for k, m in met):
                found.append((label, sum(map(len, lines[:i])), sum(map(len, lines[: j + 1])) - 1, n / len(need)))
    return sorted(found)


def test_templates_that_wrap(frame):
    layouts = {
        "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software",
        "bsd": "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted",
        "mpl": "/* This Source Code Form is subject to the terms of the Mozilla Public\r\n * License, v. 2.0.",
        "gpl": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General\nPublic License as published",
        "all-rights-reserved": "Copyright (c) 2020 Somebody\nAll rights reserved.",
    }
    rows = [(i, f"Other words before\n{t}\nother words after") for i, t in enumerate(layouts.values())]
    got = {r["doc_id"]: r["labels"] for r in license_scan(frame(rows)).collect()}
    assert [got[i] for i in range(len(rows))] == list(layouts)
    apart = [(1, "Copyright\n\nAll rights reserved"), (2, "Copyright"), (3, "All rights reserved")]
    assert all(r["labels"] == "" for r in license_scan(frame(apart)).collect())


def test_wrapped_same_as_brute_force(frame):
    rng = random.Random(6)
    rows = []
    for i in range(150):
        words = [w for _ in range(rng.randint(1, 3)) for w in rng.choice(TEMPLATES)[0].split() + ["x"] * rng.randint(0, 3)]
        rows.append((i, "".join(w + rng.choice([" ", " ", " ", "\n", " \n", "\n\n" if rng.random() < 0.2 else " "]) for w in words)))
    got = {r["doc_id"]: sorted(tuple(b) for b in r["blocks"]) for r in license_scan(frame(rows)).collect()}
    assert got == {i: by_lines(t) for i, t in rows}
    assert sum(map(len, got.values())) > 100
