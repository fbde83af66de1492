"""Operator 2: base spans against the plain patterns, estimates against a known truth."""

import hashlib
import random
import re
import time

import numpy as np

from assayframe.llm import pii_votes as pv

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind != "ip"
                or all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and plain_luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, *m.span()))
    return out


def made_texts(n):
    draw = random.Random(8)
    bits = [
        "a", "b.c", "@", "@x.com", ".", "-", " ", "+", "(", ")", "4111111111111111", "4111 1111 1111 1111",
        "1.2.3.4", "256.1.1.1", "+49 30 1234567", "555", "12", "%", "\n", "٣", "é", "(at)", "7" * 17,
    ]
    for _ in range(n):
        yield "".join(draw.choices(bits, k=draw.randint(0, 14)))


def test_base_spans(given):
    for text in [*made_texts(6_000), *(r["text"] for r in given.values())]:
        found = [(k, a, b) for k, a, b, base in pv.candidates(text) if base]
        assert sorted(found) == sorted(plain_base(text)), text


def timed(text, model=pv.SpanModel()):
    start = time.perf_counter()
    spans = pv.spans_of(text, model)
    assert time.perf_counter() - start < 2
    return spans


def test_long_runs_of_digits():
    """No crash and no more than linear time, with the spans of the plain patterns."""
    draw = random.Random(13)
    million = "".join(draw.choices("0123456789", k=1_000_000))
    for text in [
        f"host {million} end",
        f"host 1.2.3.{'4' * 5_000} and 1.2.{'0' * 5_000}3.4 and {'7' * 5_000}.1.2.3",
        "1.2.3.4." * 10_000,
        "4111111111111111 " * 500 + "+" + "1 " * 20_000,
    ]:
        found = [s[:3] for s in timed(text) if s[3]]
        if text.startswith(f"host {million[:9]}"):
            assert found == []
        else:
            assert sorted(found) == sorted(plain_base_of_long(text))
    many = "555-123-4567 .. " * 50_000
    sure = pv.SpanModel(np.full(pv.PLACES, 9.0))
    start = time.perf_counter()
    found = pv.candidates(many)
    assert time.perf_counter() - start < 2 and len(found) >= 50_000
    held = pv.Held([])
    start = time.perf_counter()
    for _, a, b, _ in found:
        if not held.overlaps(a, b):
            held.add(a, b)
    assert time.perf_counter() - start < 2
    assert len(pv.spans_of(many[:16_000], sure)) == 1_000


def plain_base_of_long(text):
    """plain_base, with numbers of any length, and without trying each digit of a long run."""
    out = []
    for kind, start, end in plain_matches(text):
        digits = re.sub("[^0-9]", "", text[start:end])
        if kind == "ip":
            parts = [p.lstrip("0") or "0" for p in text[start:end].split(".")]
            good = all(len(p) <= 3 and int(p) <= 255 for p in parts)
        else:
            good = 16 <= len(digits) <= 19 and plain_luhn(digits) if kind == "card" else 8 <= len(digits) <= 15
        if good:
            out.append((kind, start, end))
    return out


def plain_matches(text):
    for kind in ("ip", "card", "phone"):
        # a match begins where its first run of digits does: trying inside one finds no other
        pattern = PLAIN[kind].replace("[0-9]+(", "(?<![0-9])[0-9]++(", 1) if kind == "ip" else PLAIN[kind]
        for m in re.finditer(pattern, text):
            yield kind, *m.span()


def test_held_intervals():
    draw = random.Random(14)
    for _ in range(300):
        base = [(a, a + draw.randint(1, 9)) for a in draw.choices(range(60), k=draw.randint(0, 6))]
        held, added = pv.Held(base), list(base)
        for _ in range(12):
            a = draw.randrange(60)
            b = a + draw.randint(1, 6)
            assert held.overlaps(a, b) == any(a < d and c < b for c, d in added)
            if not held.overlaps(a, b):
                held.add(a, b)
                added.append((a, b))


def test_reliabilities_of_made_votes():
    """Labelers of known error rates on a known truth."""
    draw = np.random.default_rng(9)
    truth = draw.random(6_000) < 0.35
    right = np.array([0.95, 0.9, 0.8, 0.7, 0.6, 0.55])
    speaks = np.array([0.9, 0.8, 0.9, 0.7, 0.8, 0.9])
    counts, of = {}, []
    for t in truth:
        yes = np.where(draw.random(6) < right, t, ~t)
        vote = np.where(draw.random(6) < speaks, np.where(yes, "+", "-"), "0")
        of.append("".join(vote))
        counts[of[-1]] = counts.get(of[-1], 0) + 1
    chances, likely = pv.reliabilities(counts)
    guessed = np.array([chances[p] > 0.5 for p in of])
    assert (guessed == truth).mean() > 0.95
    share = likely[1, :, 0] / (likely[1, :, 0] + likely[1, :, 2])
    assert np.abs(share - right).max() < 0.06


def test_classifier_learns_soft_labels():
    draw = np.random.default_rng(10)
    places = [sorted(set(draw.integers(0, 40, 5).tolist())) for _ in range(2_000)]
    chance = np.array([0.95 if 7 in p else 0.05 for p in places])
    model = pv.SpanModel(pv.fit_classifier(places, chance))
    assert model.probability([1, 3, 7, 12, 20]) > 0.8
    assert model.probability([1, 3, 8, 12, 20]) < 0.2


def context_docs(spark):
    """Numbers of a loose form: behind cues they are phones, behind others they are not."""
    draw = random.Random(11)
    rows = []
    for i in range(600):
        number = f"{draw.randint(200, 999)}-{draw.randint(200, 999)}-{draw.randint(1000, 9999)}"
        if i % 3 == 0:
            rows.append((i, f"please call my phone +1 {number} today"))
        elif i % 3 == 1:
            rows.append((i, f"please call my phone {number} today"))
        else:
            rows.append((i, f"the order token {number}x9 was shipped"))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_the_method_adds_spans_and_keeps_base_ones(spark):
    docs = context_docs(spark)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    added = {0: 0, 1: 0, 2: 0}
    for r in pv.found(docs).collect():
        spans = [s.split(":") for s in r["spans"].split(",") if s]
        spans = {(k, int(a), int(b)) for k, a, b in spans}
        base = plain_base(texts[r["doc_id"]])
        assert spans >= set(base)
        added[r["doc_id"] % 3] += len(spans) - len(base)
    assert added[0] == 0 and added[1] > 150 and added[2] < 10


def check_digests(rows, texts):
    for r in rows:
        base = plain_base(texts[r["doc_id"]])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        for kind in pv.KINDS:
            assert r[f"n_{kind}"] == sum(k == kind for k, _, _ in base)
        for span in filter(None, listed.split(",")):
            assert span in r["spans"].split(",")


def test_query(spark, sf_dir, given):
    rows = pv.query(spark, sf_dir).collect()
    assert len(rows) == len(given)
    check_digests(rows, {i: r["text"] for i, r in given.items()})


def test_edge_rows(edge_docs, no_docs):
    rows = pv.found(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    check_digests([r for r in rows if r["doc_id"]], {r["doc_id"]: r["text"] or "" for r in edge_docs.collect()})
    assert pv.found(no_docs).count() == 0
    masked = pv.mask_rows(edge_docs)
    assert masked.columns == edge_docs.columns and masked.dtypes == edge_docs.dtypes
    by_id = {r["doc_id"]: r for r in masked.collect()}
    assert by_id[7]["text"] == "mail me at [EMAIL] or [PHONE] now"
    assert by_id[7]["n_chars"] == len(by_id[7]["text"])
    assert by_id[2]["text"] is None and by_id[3]["text"] == ""


def test_masking_of_overlapping_spans():
    spans = [
        {"kind": "card", "start": 2, "end": 6},
        {"kind": "phone", "start": 4, "end": 9},
        {"kind": "ip", "start": 9, "end": 11},
    ]
    assert pv.masked("ab0123456789cd", spans) == "ab[CARD][IP]9cd"
