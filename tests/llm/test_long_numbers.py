"""Digit runs longer than Python turns into a number."""

from sparkexp.llm.pii import base_spans


def test_ip_parts_of_any_length():
    zeros = "0" * 5000
    assert base_spans(zeros + ".1.1.1") == [("ip", 0, 5006)]
    assert base_spans(zeros + "255.01.000.0") == [("ip", 0, 5012)]
    assert base_spans("1" * 5000 + ".1.1.1") == [] and base_spans("256.1.1.1") == []
