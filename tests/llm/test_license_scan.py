from __future__ import annotations

import random
import textwrap
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from samples import corpus

from tripmart.llm import license_scan as s
from tripmart.llm.common import terms
from tripmart.llm.oracles import OP6


def rows_with_notices(seed):
    rnd = random.Random(seed)
    rows = []
    for i, (_, text) in enumerate(corpus(seed, 40)):
        notice = rnd.choice(list(s.TEMPLATES.values())).split()
        for _ in range(rnd.randint(0, 3)):
            notice[rnd.randrange(len(notice))] = rnd.choice(["x", "the", "license"])
        joint = rnd.choice(["\n", ". ", " ", "\n\n"])
        rows.append((i, None if text is None else text + joint + " ".join(notice) + joint + "tail of the text"))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_sql(frame, sql, result, seed):
    rows = rows_with_notices(seed)
    assert result(s.op6_license_scan(frame(rows))) == sql(OP6, rows)


def test_size_bounds_lose_nothing():
    rnd = random.Random(4)
    words = "a b c d e f".split()
    templates = {f"t{i}": " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 14))) for i in range(30)}
    scanner = s.Scanner(templates, 0.6)
    for _ in range(300):
        text = " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 14)))
        mine = s.bigrams(text)
        wanted = set()
        for name, t in templates.items():
            theirs = s.bigrams(t)
            if mine and theirs and 2 * len(mine & theirs) / (len(mine) + len(theirs)) >= 0.6:
                wanted.add(name)
        assert {n for _, n in scanner.passage(text)} == wanted


def test_templates_find_themselves(frame):
    found = {r["doc_id"]: r for r in s.op6_license_scan(frame(list(enumerate(s.TEMPLATES.values())))).collect()}
    for i, name in enumerate(s.TEMPLATES):
        if len(terms(s.TEMPLATES[name])) > 1:
            assert name in found[i]["licences"].split(",") and found[i]["best_dice"] == 1.0


def test_nulls_clashing_columns_and_empty_table(frame):
    docs = frame([(1, None), (2, ""), (3, "All rights reserved."), (3, "All rights reserved.")])
    clash = docs.withColumns({c: F.lit(1) for c in ("licences", "best", "n_licences")})
    assert sorted(tuple(r)[:3] for r in s.op6_license_scan(clash).collect()) == [
        (1, "", 0),
        (2, "", 0),
        (3, "all-rights-reserved", 1),
        (3, "all-rights-reserved", 1),
    ]
    assert s.op6_license_scan(docs.limit(0)).collect() == []


def best_of_all_windows(text, template):
    words, theirs = terms(text), s.bigrams(template)
    pairs = list(zip(words, words[1:], strict=False))
    best = 0.0
    for i in range(len(pairs)):
        for j in range(i + 1, len(pairs) + 1):
            mine = set(pairs[i:j])
            best = max(best, 2 * len(mine & theirs) / (len(mine) + len(theirs)))
    return best


@pytest.mark.parametrize("threshold", [0.5, 0.6, 0.8])
def test_windows_equal_to_brute_force(threshold):
    rnd = random.Random(6)
    words = "a b c d e f".split()
    templates = {f"t{i}": " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 10))) for i in range(12)}
    scanner = s.WindowScanner(templates, threshold)
    for _ in range(60):
        text = rnd.choice([" ", "\n", ". "]).join(rnd.choice(words) for _ in range(rnd.randint(0, 40)))
        wanted = {n: best_of_all_windows(text, t) for n, t in templates.items() if s.bigrams(t)}
        assert scanner.document(text) == {n: d for n, d in wanted.items() if d >= threshold}


def test_wrapped_notices_are_found(frame):
    prose = "some prose about boats and rivers that goes on for a while " * 8
    notice = "This work is licensed under the GNU\nGeneral Public License, version 3."
    rows = [
        (1, f"{prose} prose here. {notice} More {prose}"),
        (2, f"{prose} and {notice.replace(chr(10), ' ').rstrip('.')} and {prose}"),
        (3, prose),
        (4, None),
    ]
    found = {r["doc_id"]: r for r in s.op6_license_windows(frame(rows)).collect()}
    for i in (1, 2):
        assert "gpl-3.0" in found[i]["licences"].split(",") and found[i]["best_dice"] == 1.0
    assert [(found[i]["licences"], found[i]["n_licences"], found[i]["best"]) for i in (3, 4)] == [("", 0, None)] * 2


def test_windows_find_all_that_passages_do():
    passages, windows = s.Scanner(s.TEMPLATES, 0.8), s.WindowScanner(s.TEMPLATES, 0.8)
    for _, text in rows_with_notices(3):
        wide = windows.document(text)
        assert all(wide[n] >= d for n, d in passages.document(text).items())


GPL_HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
    "option) any later version."
)


def test_verbatim_licences_are_found_wrapped_and_unwrapped(frame):
    prose = "some prose about boats and rivers that goes on for a while " * 8
    texts = {p.stem: p.read_text() for p in sorted((Path(s.__file__).parent / "licences").glob("*.txt"))}
    texts |= {"gpl-3.0 header": GPL_HEADER}
    rows, names = [], []
    for name, text in texts.items():
        for width in (None, 40, 72, 79):
            shown = " ".join(text.split())
            if width:
                shown = "\n".join(f" * {line}" for line in textwrap.wrap(shown, width))
            rows.append((len(rows), f"{prose}\n{shown}\n{prose}"))
            names.append(name)
    templates = s.licence_texts()
    found = {r["doc_id"]: r for r in s.op6_license_windows(frame(rows)).collect()}
    for i, name in enumerate(names):
        assert name.split()[0] in found[i]["licences"].split(",")
        own = {t for t in templates if t.startswith(f"{name}/") and t[-3:].isdigit()}
        assert own <= set(found[i]["parts"].split(","))


def test_titles_and_bodies_have_templates():
    templates = s.licence_texts()
    for name in ("mit", "isc", "bsd-2-clause", "bsd-3-clause", "apache-2.0", "gpl-2.0", "gpl-3.0", "lgpl-2.1", "mpl-2.0"):
        assert f"{name}/title-0" in templates and sum(t.startswith(f"{name}/") for t in templates) >= 4
