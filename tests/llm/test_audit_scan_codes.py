"""Filter audit, license scan and vector codes against plain Python on small fixtures: nulls, ties, repeated rows, empty tables, clashing names."""

import hashlib
import math
import random
import re
from itertools import permutations

import numpy as np
import pytest

from strandline.llm import filter_audit, license_scan, vector_codes

DOCS = "doc_id long, text string, lang string, source string, part string, words int, label int, mask string, found int"


def docs_of(spark, rows):
    """(doc_id, text, source) with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", s, "x", 1, 2, "m", 3) for i, t, s in rows], DOCS)


# filter audit ----------------------------------------------------------------


def audit_rows():
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(80)] + ["UP", "Cap", "a#b", "c|d"]
    rows = []
    for i in range(120):
        n = rnd.choice([0, 3, 49, 50, 51, 120])
        words = [rnd.choice(vocabulary[: rnd.choice([8, 84])]) for _ in range(n)]
        rows.append((i, rnd.choice([" ", "\n", " \t "]).join(words), rnd.choice(["a", "b", None, ""])))
    rows += [(200 + i, "the same text again", "hot") for i in range(40)]  # copies within and across parts
    rows += [(300, "the same text again", "b"), (5, "the same text again", "b"), (None, "the same text again", "b"), (None, None, None), (400, None, "a"), (401, "", "a")]
    rows += [rows[7], rows[7], (7, "another text of the same id", "b"), (500, "Word " * 200_000, "long"), (501, "É" * 60, "long")]
    rnd.shuffle(rows)
    return rows


LABELS = [(i, i % 2, int(i % 7 == 0)) for i in range(0, 310, 3)] + [(3, 1, 1), (None, 1, 1), (9, None, None), (5, 1, 0), (5, 0, 1)]


def plain_audit(rows, labels):
    known = lambda i: math.inf if i is None else i
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    smallest = {}
    for i, t, _ in rows:
        smallest[t or ""] = min(smallest.get(t or "", math.inf), known(i))
    judged = []
    for i, t, s in rows:
        t = t or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        fails = set()
        fails |= {"A"} if len(words) < 50 else set()
        fails |= {"B"} if 100 * len(set(words)) < 65 * len(words) else set()
        fails |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t) else set()
        fails |= {"D"} if set(t) & set("#$%&*|") else set()
        fails |= {"E"} if known(i) > smallest[t] else set()
        judged.append((s or "", fails, i in good, i in toxic))
    out = {}
    for part in {j[0] for j in judged}:
        own = [j for j in judged if j[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for k, f in enumerate(order, 1):
                gone, left = [j for j in left if f in j[1]], [j for j in left if f not in j[1]]
                total[f] += len(gone)
                out[part, "".join(order), k] = [len(left), len(gone), sum(f in j[1] for j in own) - len(gone), sum(j[1] == {f} for j in own), sum(j[2] for j in gone), sum(j[3] for j in gone), f]
        for (p, order, k), row in out.items():
            if p == part:
                row.insert(6, total[row[-1]])
    return {k: tuple(v) for k, v in out.items()}


def test_filter_audit(spark):
    rows = audit_rows()
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    counted = filter_audit.masks(docs_of(spark, rows), labels)
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in filter_audit.audit(counted, "ABCDE").collect()}
    want = plain_audit(rows, LABELS)
    assert len(found) == len(want) == 600 * len({s or "" for _, _, s in rows})
    assert found == want


def test_filter_audit_of_nothing(spark):
    counted = filter_audit.masks(docs_of(spark, []), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert filter_audit.audit(counted, "ABCDE").count() == 0
    with pytest.raises(ValueError):
        filter_audit.audit(counted, "AA")


def test_zeta_adds_subsets():
    counts = np.random.default_rng(5).integers(0, 9, (3, 2, 16))
    sums = filter_audit.zeta(counts, 4)
    for s in range(16):
        assert (sums[..., s] == sum(counts[..., m] for m in range(16) if m & ~s == 0)).all()


def test_other_filters(spark):
    docs = docs_of(spark, [(1, "x y", "p"), (2, "x", "p"), (3, "x", "p")])
    labels = spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int")
    counted = filter_audit.masks(docs, labels, {"S": lambda text, words: F_size(words) < 2})
    rows = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"], r["shapley"]) for r in filter_audit.audit(counted, "SE").collect()}
    assert rows == {("SE", 1): (1, 2, 0, 1, 1, 3), ("SE", 2): (1, 0, 1, 0, 0, 1), ("ES", 1): (2, 1, 0, 0, 1, 1), ("ES", 2): (1, 1, 1, 1, 0, 3)}


def F_size(words):
    from pyspark.sql import functions as F

    return F.size(words)


# license scan ----------------------------------------------------------------


def plain_scan(text, templates=license_scan.TEMPLATES, phrases=license_scan.PHRASES, threshold=license_scan.THRESHOLD):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower) if w]
    places, base = [], set()
    for label, phrase in phrases:
        p = phrase.split()
        own = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += own
        base |= {label} if own else set()
    found = []
    for label, template in templates:
        t, c = set(template.split()), license_scan.step_of(template)
        for b in range(-(-len(words) // c)):
            shared = len(t & set(words[b * c : b * c + 2 * c]))
            if shared >= license_scan.least_shared(template, threshold):
                found.append((label, b * c, len(words[b * c : b * c + 2 * c]), shared / len(t)))
    score = 1.0 if places else max([f[3] for f in found], default=0.0)
    labels = base | {f[0] for f in found}
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score, len(found)), sorted(found)


def license_texts():
    rnd = random.Random(12)
    filler = ["the", "of", "and", "license", "software", "under", "x1", "word", "is", "any", "to"]
    out = [None, "", " .,-", "mit license", "MIT-License, mit LICENSE!", "mit licenses", "apache mit license general public license", "mit mit license license", "the apache\x00license", "MIT Lİcense", "é mit license é", "mit license " * 3, "general public public license"]
    for label, template in license_scan.TEMPLATES:
        words = template.split()
        for lost in (0, 1, 2, 3):
            kept = [w for i, w in enumerate(words) if i not in rnd.sample(range(len(words)), lost)]
            lead = [rnd.choice(filler) for _ in range(rnd.randint(0, 70))]
            rnd.shuffle(kept) if lost == 1 else None
            out.append(rnd.choice([" ", ", ", "\n"]).join([*lead, *kept, *(rnd.choice(filler) for _ in range(rnd.randint(0, 40)))]).title())
    out.append(" ".join(rnd.choice(filler) for _ in range(60_000)) + " " + license_scan.TEMPLATES[4][1])  # a long text, its notice at the end
    out.append((license_scan.TEMPLATES[9][1] + " ") * 3000)  # one notice all over
    return out


def test_license_scan(spark):
    texts = license_texts()
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, "mit license", None), (3, "mit license", "s"), (3, "nothing here", "s")]
    found = license_scan.scan(docs_of(spark, rows)).collect()
    assert len(found) == len(rows)
    want = {}
    for i, t, _ in rows:
        want.setdefault(i, []).append(plain_scan(t))
    for r in found:
        own = (tuple(r)[1:9], sorted(tuple(f) for f in r["found"]))
        assert own in want[r["doc_id"]], (r["doc_id"], own)
    assert {r["labels"] for r in found} > {"mit", "apache", "bsd", "isc", "mpl", "unlicense"}


@pytest.mark.parametrize("threshold", [1, 50, 75, 100])
def test_every_block_that_fits_is_found(spark, threshold):
    rnd = random.Random(threshold)
    words = [f"t{i}" for i in range(14)]
    templates = [(f"l{i}", " ".join(rnd.choice(words) for _ in range(n))) for i, n in enumerate((1, 2, 5, 9, 20))]
    texts = [" ".join(rnd.choice([*words, "other"]) for _ in range(rnd.randint(0, 90))) for _ in range(40)]
    found = license_scan.scan(docs_of(spark, [(i, t, "s") for i, t in enumerate(texts)]), templates, [("x", "t1 t2 t3")], threshold).collect()
    for r in found:
        assert (tuple(r)[1:9], sorted(tuple(f) for f in r["found"])) == plain_scan(texts[r["doc_id"]], templates, [("x", "t1 t2 t3")], threshold)


def test_license_scan_of_nothing(spark):
    assert license_scan.scan(docs_of(spark, [])).count() == 0
    only = license_scan.scan(docs_of(spark, [(1, "mit license", "s")]), templates=[]).head()
    assert (only["labels"], only["score"], only["n_blocks"]) == ("mit", 1.0, 0)
    with pytest.raises(ValueError):
        license_scan.scan(docs_of(spark, []), threshold=0)


# vector codes ----------------------------------------------------------------


def plain_codes(rows, parts, entries, rounds, scale):
    kept = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    books = [[r[1][p * width : (p + 1) * width] for r in kept[:entries]] for p in range(parts)]
    near = lambda v, p: min((sum((a - b) ** 2 for a, b in zip(v[p * width : (p + 1) * width], e)), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        told = [[near(v, p)[1] for p in range(parts)] for _, v, _ in kept]
        new = [[list(e) for e in book] for book in books]
        for p in range(parts):
            for k in range(len(books[p])):
                own = [v[p * width : (p + 1) * width] for (_, v, _), t in zip(kept, told) if t[p] == k]
                if own:
                    new[p][k] = [sum(x) // len(own) for x in zip(*own)]
        books = new
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    coded = [(i, [near(v, p) for p in range(parts)], label) for i, v, label in kept]
    sums = {}
    for _, found, label in coded:
        sums[label] = sums.get(label, 0) + sum(d for d, _ in found)
    return sorted(((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), sums[label], sha) for i, found, label in coded), key=str)


def vectors_of(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, error string, own_label int, n string"
    return spark.createDataFrame([(i, v, label, "e", 4, "n") for i, v, label in rows], schema)


def vector_rows(n, width, seed):
    rnd = random.Random(seed)
    own = lambda: [rnd.choice([-1.5, -0.25, 0.0, 0.125, 0.5, 2.0]) + rnd.randint(-3, 3) / 64 for _ in range(width)]
    rows = [(i * 3 - 20, own(), rnd.choice([0, 0, 0, 1, None])) for i in range(n)]
    bad = [(1000, None, 1), (1001, [], 1), (-500, [None] + own()[1:], 1), (1003, own()[1:] + [float("nan")], 0), (1004, own()[1:] + [float("inf")], 0)]
    rows += [*bad, rows[0], rows[0], (None, own(), 5), (None, own(), None)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("n, width, parts, entries, rounds", [(150, 32, 16, 64, 2), (40, 16, 16, 64, 2), (90, 12, 4, 8, 3), (30, 6, 2, 1, 1), (25, 4, 4, 5, 0)])
def test_vector_codes(spark, monkeypatch, n, width, parts, entries, rounds):
    monkeypatch.setattr(vector_codes, "SHARE", 4)  # labels on both ways
    rows = vector_rows(n, width, n)
    found = vector_codes.compress(vectors_of(spark, rows).repartition(5), parts, entries, rounds)
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain_codes(rows, parts, entries, rounds, 256)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**19 * (i % 5 - 2)) + i, float(i)], None) for i in range(30)]
    found = vector_codes.compress(vectors_of(spark, rows), 2, 4, 2)
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain_codes([(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows], 2, 4, 2, 256)


def test_vectors_that_do_not_fit_are_errors(spark):
    with pytest.raises(Exception, match="length"):
        vector_codes.compress(vectors_of(spark, [(1, [1.0, 2.0, 3.0], 1)]), 2).count()
    with pytest.raises(Exception, match="length|components"):
        vector_codes.compress(vectors_of(spark, [(1, [1.0, 2.0], 1), (2, [1.0] * 4, 1)]), 2, 1).collect()


def test_no_vectors(spark):
    for rows in ([], [(1, None, 2)]):
        found = vector_codes.compress(vectors_of(spark, rows))
        assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
        assert found.count() == 0
