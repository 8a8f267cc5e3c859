import random

import pytest

from fieldrank.llm import licenses
from fieldrank.llm.decontamination import words_of
from fieldrank.llm.license_texts import TEMPLATES


def brute(text, templates):
    """All finds of a text: every window of the grid against every template."""
    words, found = words_of((text or "").encode()), []
    every = [
        (name, set(licenses.shingles(words_of(version.encode()))))
        for name, versions in templates.items() for version in versions
    ]
    total = len(words) - licenses.SHINGLE + 1
    for name, parts in every:
        top = licenses.size_class(len(parts))
        width = -int(-licenses.WIDER * top // 1)
        start = 0
        while total > 0:
            last = min(start + width, total)
            at = [i for i in range(start, last) if b" ".join(words[i:i + 5]) in parts]
            held = {b" ".join(words[i:i + 5]) for i in at}
            if len(held) >= licenses.CONTAINED * len(parts) and all(
                len(held - other) >= len(parts - other) / 2
                for owner, other in every if owner != name
            ):
                missed = len(parts) - len(held)
                found.append((
                    missed - len(held), -len(held) / len(parts), at[0], at[-1] + 5, name
                ))
            if start + width >= total:
                break
            start += width - top + 1
    kept = []
    for find in sorted(set(found)):
        start, end = find[2:4]
        if all(
            2 * (min(end, e) - max(start, s)) < min(end - start, e - s) for _, _, s, e, _ in kept
        ):
            kept.append(find)
    return sorted((s, e, name, -share) for _, share, s, e, name in kept)


def texts(seed):
    rng = random.Random(seed)
    def filler(n):
        return " ".join(rng.choice(["the", "software", "license", "under", "copy", "zzz", "of"]) for _ in range(n))
    out = []
    for name, versions in TEMPLATES.items():
        for version in versions:
            words = version.split()
            for changed in (0, 1, len(words) // 12):
                copy = list(words)
                for _ in range(changed):
                    copy[rng.randrange(len(copy))] = "changed"
                out.append(f"{filler(rng.randint(0, 90))}\n{' '.join(copy)}\n{filler(rng.randint(0, 90))}")
    return out + [filler(300), "MIT", ""]


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(documents, seed):
    docs = list(enumerate(texts(seed)))
    rows = licenses.scanned(documents(*docs)).collect()
    found = {
        r.doc_id: sorted((f.start, f.end, f.license, f.containment) for f in r.finds) for r in rows
    }
    expected = {i: brute(text, TEMPLATES) for i, text in docs}
    assert found == expected
    assert {f[2] for finds in expected.values() for f in finds} == set(TEMPLATES)
    assert all(r.n_finds == len(r.finds) for r in rows)
    assert all(
        r.licenses == ",".join(sorted({f[2] for f in expected[r.doc_id]})) for r in rows
    )


def test_documents_do_not_meet_in_a_slice():
    built = licenses.Templates(TEMPLATES)
    parts = [words_of(t.encode()) for t in texts(3)] + [[b"released"], words_of(b"under the MIT License")]
    assert licenses.scan(parts, built) == [licenses.scan([p], built)[0] for p in parts]
    assert licenses.scan(parts, built)[-1] == []


def test_finds_say_where(documents):
    text = "a b c " * 50 + "Licensed under the Apache License, Version 2.0. " + "d e " * 30
    (find,) = licenses.scanned(documents((1, text))).first().finds
    assert find.license == "Apache-2.0" and find.containment == 1.0
    assert (find.start, find.end) == (150, 158)


@pytest.mark.parametrize("text, expected", [
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    ("This work is licensed under the GNU General Public License, version 1.", ""),
    (TEMPLATES["GPL-3.0"][1], "GPL-3.0"),
    (TEMPLATES["GPL-3.0"][1].replace("version 3", "version 1"), ""),
    (TEMPLATES["AGPL-3.0"][1], "AGPL-3.0"),
    (TEMPLATES["LGPL-2.1"][1], "LGPL-2.1"),
    (TEMPLATES["LGPL-3.0"][1], "LGPL-3.0"),
    (TEMPLATES["BSD-2-Clause"][0], "BSD-2-Clause"),
    (TEMPLATES["BSD-3-Clause"][1], "BSD-3-Clause"),
    ("Released under the MIT License or, if you like, "
     "licensed under the Apache License, Version 2.0.", "Apache-2.0,MIT"),
])
def test_the_best_template_names_the_licence(documents, text, expected):
    assert licenses.scanned(documents((1, f"x y z {text} u v w"))).first().licenses == expected


def test_every_template_names_itself():
    built = licenses.Templates(TEMPLATES)
    for name, versions in TEMPLATES.items():
        for version in versions:
            (finds,) = licenses.scan([words_of(version.encode())], built)
            assert {f.license for f in finds} == {name}


def test_only_bands_retrieve():
    built = licenses.Templates(TEMPLATES)
    built.by_band = [(known[:0], owner[:0]) for known, owner in built.by_band]
    assert licenses.scan([words_of(b"Released under the MIT License.")], built) == [[]]


def test_band_settings():
    worst = min(licenses.least_jaccard(size) for size in range(1, 3000))
    assert worst > 0.45 and licenses.collision_probability(worst) > 0.99998


def test_odd_documents(odd_documents, clashing):
    rows = licenses.scanned(clashing(odd_documents)).collect()
    assert len(rows) == 12 and {r.licenses for r in rows} == {""}
    assert licenses.scanned(odd_documents.limit(0)).collect() == []


def test_a_licence_in_every_line(documents):
    text = "Released under the MIT License.\n" * 3000
    row = licenses.scanned(documents((1, text))).first()
    assert row.licenses == "MIT" and row.n_finds == 3000
