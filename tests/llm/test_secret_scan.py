import hashlib
import random
import re

from folioflow.llm import secret_scan as ss
from folioflow.llm.secret_scan import BASE58, BASE62, base62_crc, find_spans

ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)


def plain(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def base(text):
    return [s for s in find_spans(text) if s[1] < 3]


def test_base_spans_on_random_texts():
    random.seed(5)
    bits = ["password", "Passwd", "SECRET", "token", "api_key", "APIKEY", "ſecret", "toKen", ":", "=", " ", "'", '"',
            "AKIA", "ABCDEFGH12345678", "0123456789abcdef" * 2, "abc", "é", "İ", "\n", "a-b/c+d=="]
    for _ in range(3000):
        text = "".join(random.choice(bits) for _ in range(random.randint(1, 12)))
        assert base(text) == plain(text), text


def test_a_failing_match_covers_its_characters():
    text = "token:secret:abcdefghij"
    assert base(text) == plain(text) == []


def test_checksums_decide():
    rng = random.Random(1)
    body = "".join(rng.choice(BASE62) for _ in range(30))
    good = "ghp_" + body + base62_crc(body)
    assert [s[1] for s in find_spans(f"x {good} y")] == [3]
    assert find_spans(f"x {good[:-1]}{'0' if good[-1] != '0' else '1'} y") == []

    raw = bytes.fromhex("0488ade4") + bytes(range(74))
    raw += hashlib.sha256(hashlib.sha256(raw).digest()).digest()[:4]
    value, text = int.from_bytes(raw, "big"), ""
    while value:
        value, digit = divmod(value, 58)
        text = BASE58[digit] + text
    assert text.startswith("xprv") and [s[1] for s in find_spans(text)] == [4]
    assert find_spans(text[:-1] + ("2" if text[-1] != "2" else "3")) == []


def test_rows(odd_docs, no_docs, documents):
    for df in (odd_docs, documents):
        got = sorted(repr((r.doc_id, [(s.start, s.kind, s.end) for s in r.spans])) for r in ss.scan(df).collect())
        names = [k.name for k in ss.KINDS]
        expected = sorted(repr((r.doc_id, [(a, names[k], b) for a, k, b in plain(r.text or "")])) for r in df.collect())
        assert got == expected
    assert ss.scan(no_docs).count() == 0
