"""Plain single-machine versions that the operators are held against."""

import hashlib
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower_ascii(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lower_ascii(text))


def substring_dedup(docs, length=100):
    """docs: (key, text) in document order -> key: (n_bytes, n_removed, n_spans, kept)."""
    seen, out = set(), {}
    for key, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            s = data[p:p + length]
            if s in seen:
                gone[p:p + length] = b"\x01" * length
            else:
                seen.add(s)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out[key] = (len(data), sum(gone), spans, kept)
    return out


def sha(data):
    return hashlib.sha256(data).hexdigest()
