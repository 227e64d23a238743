"""License scans against counting every block of every text."""
import random

import pytest

from ticketlake.llm.license_scans import PHRASES, TEMPLATES, Templates, report, scan_licenses

from .test_text_operators import NASTY, alnum, frame, words

SMALL = (("x", "a b c d"), ("y", "a a b the the of"), ("z", "q"), ("none", " . "), ("x", "the of a e f g h k"))
SAID = (("a b", "ab"), ("the the", "the"), ("...", "none"), ("q", "ab"))


def plain(rows, templates, phrases, percent):
    """Report, places and covered words of each template for every row."""
    out = []
    for i, t in rows:
        w = words(t, alnum)
        places = sorted((label, s, s + len(p)) for text, label in phrases if (p := words(text, alnum)) for s in range(len(w) - len(p) + 1) if w[s : s + len(p)] == p)
        more, covered, share = set(), set(), 0.0
        for k, (label, text) in enumerate(templates):
            v = words(text, alnum)
            for s in range(max(len(w) - len(v), 0) + 1 if v and w else 0):
                n = len(set(v) & set(w[s : s + len(v)]))
                if 100 * n >= percent * len(set(v)):
                    more.add(label)
                    share = max(share, n / len(set(v)))
                    covered |= {(k, at) for at in range(s, min(s + len(v), len(w)))}
        starts, base = [p[1] for p in places], {p[0] for p in places}
        report = (i, len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if places else share)
        out.append((report, places, sorted(covered)))
    return sorted(out, key=str)


@pytest.mark.parametrize("percent", [50, 75, 100])
def test_every_block_is_found(spark, percent):
    rng = random.Random(percent)
    rows = [(i, " ".join(rng.choice(["a", "b", "c", "d", "the", "of", "E", "f", "q" if i % 9 == 0 else "g", "u", "v", "w"]) for _ in range(rng.randint(0, 40)))) for i in range(60)]
    rows += NASTY + [rows[3], rows[3], (500, "u v w " * 20_000 + "a b c d"), (501, "a"), (502, "a b the of")]
    scanned = scan_licenses(frame(spark, rows), SMALL, SAID, percent)
    got = []
    for r, x in zip(scanned.collect(), report(scanned).collect(), strict=True):
        covered = {(b.template, at) for b in r.blocks for at in range(b.start, b.stop)}
        got.append((tuple(x), sorted((p.label, p.start, p.stop) for p in r.places), sorted(covered)))
    assert sorted(got, key=str) == plain(rows, SMALL, SAID, percent)


def test_spans_join_overlapping_blocks(spark):
    rows = [(1, "u a b c d u"), (2, "a b c d a b c d u u u u u u b c d a"), (3, "u")]
    got = {r.doc_id: [(b.start, b.stop, b.containment) for b in r.blocks] for r in scan_licenses(frame(spark, rows), SMALL[:1], (), 100).collect()}
    assert got == {1: [(1, 5, 1.0)], 2: [(0, 8, 1.0), (14, 18, 1.0)], 3: []}


def test_notices_carry_their_own_label(spark):
    rows = [(k, f"Some words before.\n\n{t}\nand after") for k, (_, t) in enumerate(TEMPLATES)]
    got = {r.doc_id: r.labels.split(",") for r in report(scan_licenses(frame(spark, rows))).collect()}
    assert all(label in got[k] for k, (label, _) in enumerate(TEMPLATES))


def test_empty_tables(spark):
    assert report(scan_licenses(frame(spark, []))).count() == 0
    assert [r.labels for r in report(scan_licenses(frame(spark, [(1, "mit license")]), (), ())).collect()] == [""]


def test_templates_are_bounded():
    with pytest.raises(ValueError):
        Templates([("x", "a" * (17 << 20))], PHRASES)
