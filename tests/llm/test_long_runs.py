"""Base spans and candidates by the plain patterns, and on texts of long runs."""

import random
import time

from sparkexp.llm import pii


def plain(text):
    out = [("email", *m.span()) for m in pii.EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in pii.IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    return sorted(out, key=lambda s: (s[1], s[0]))


def test_spans_are_those_of_the_patterns():
    r = random.Random(2)
    for _ in range(20_000):
        text = "".join(r.choices("a1.@-2 +é%", k=r.randint(0, 30)))
        got = [s for s in pii.base_spans(text) if s[0] in ("email", "ip")]
        assert sorted(got, key=lambda s: (s[1], s[0])) == plain(text), text


def test_candidates_do_not_overlap():
    r = random.Random(3)
    parts = ["(555) 123-4567", " a.b@c.de ", "1.2.3.4", " Mr John Smith", " 0555 123 4567 ", "GB82 WEST 1234 5698 7654 32", " +1 482 555 7163", "x"]
    for _ in range(500):
        text = " ".join(r.choices(parts, k=8))
        base = pii.base_spans(text)
        taken = [(a, b) for _, a, b in base]
        got = list(pii.candidates(text, base))
        for _, a, b in got:
            assert all(b <= x or a >= y for x, y in taken)
            taken.append((a, b))
        for kind, pattern in pii.LOOSE.items():  # what is no candidate overlaps something
            for m in pattern.finditer(text):
                assert (kind, *m.span()) in got or any(m.start() < y and m.end() > x for x, y in taken)


def test_long_runs_take_linear_time():
    t0 = time.perf_counter()
    for text in ("a" * 1_000_000 + " @", "a@" * 500_000, "1" * 1_000_000 + ".", "1." * 500_000, "+1" * 500_000, "(555) 123-4567 " * 50_000):
        list(pii.candidates(text, pii.base_spans(text)))
    assert time.perf_counter() - t0 < 60
