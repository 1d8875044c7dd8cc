"""Scalar rules against small Python models of the JavaScript behaviour."""

import re
import urllib.parse

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from folio.functions import values as V
from folio.functions.links import encode_uri_component
from folio.functions.text import JS_TRIM_CHARS, search_gate

JS_SPACE = (" \t\n\x0b\x0c\r\u00a0\ufeff\u1680\u2028\u2029\u202f\u205f\u3000"
            + "".join(chr(c) for c in range(0x2000, 0x200B)))


def js_parse_int(s):
    """parseInt(s) with radix omitted, as an int or None for NaN."""
    i = 0
    while i < len(s) and s[i] in JS_SPACE:
        i += 1
    sign = 1
    if i < len(s) and s[i] in "+-":
        sign = -1 if s[i] == "-" else 1
        i += 1
    if s[i:i + 2].lower() == "0x":
        m = re.match(r"[0-9a-fA-F]+", s[i + 2:])
        return sign * int(m.group(0), 16) if m else None
    m = re.match(r"[0-9]+", s[i:])
    return sign * int(m.group(0)) if m else None


texts = st.text(alphabet=st.sampled_from(list("0123456789+-xXabAB .e\t\u00a0\u3000")), max_size=12)
SETTINGS = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(texts, min_size=50, max_size=50))
def test_parse_int_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(V.parse_int("x", "bigint")).collect()]
    want = [js_parse_int(v) for v in values]
    want = [w if w is None or -(2 ** 63) <= w < 2 ** 63 else None for w in want]
    assert got == want


@SETTINGS
@given(st.lists(st.text(max_size=10).filter(lambda t: not any(0xD800 <= ord(c) <= 0xDFFF for c in t)),
                min_size=50, max_size=50))
def test_encode_uri_component_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(encode_uri_component("x")).collect()]
    assert got == [urllib.parse.quote(v, safe="-_.!~*'()") for v in values]


@given(st.text(max_size=8))
def test_search_gate_matches_trim(q):
    assert search_gate(q) == bool(q.strip(JS_TRIM_CHARS))
