import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from corpusflow.llm import media as M


class Writer:
    """A plain bit writer and progressive encoder, one symbol at a time, for any coefficients."""

    def __init__(self):
        self.bits = []

    def put(self, value, n):
        self.bits += [value >> k & 1 for k in range(n - 1, -1, -1)]

    def done(self):
        bits = self.bits + [1] * (-len(self.bits) % 8)
        self.bits = []
        return bytes(int("".join(map(str, bits[k : k + 8])), 2) for k in range(0, len(bits), 8)).replace(b"\xff", b"\xff\x00")


def seg(code, part):
    return bytes((0xFF, code)) + (len(part) + 2).to_bytes(2, "big") + part


def table(kind, symbols):
    """A code of lengths 2, 3, 4, ... and then 12 bits for all the rest, so that lengths differ."""
    counts, n = [0] * 16, len(symbols)
    head = min(6, n)
    for k in range(head):
        counts[k + 1] = 1
    counts[11] += n - head
    codes, code, k = {}, 0, 0
    for length, c in enumerate(counts, 1):
        for _ in range(c):
            codes[symbols[k]] = (code, length)
            code, k = code + 1, k + 1
        code <<= 1
    return bytes([kind]) + bytes(counts) + bytes(symbols), codes


def number(w, v):
    n = abs(v).bit_length()
    if n:
        w.put(v if v > 0 else v + (1 << n) - 1, n)


def shift(v, low):
    return -((-v) >> low) if v < 0 else v >> low


def encode(width, height, samplings, coefs, bands, quant):
    """``coefs[c]`` has rows of 64 in zigzag order over the padded block grid of component c."""
    comps = [(k + 1, h, v) for k, (h, v) in enumerate(samplings)]
    top_h, top_v = max(h for _, h, _ in comps), max(v for _, _, v in comps)
    wide, high = -(-width // (8 * top_h)), -(-height // (8 * top_v))
    out = [b"\xff\xd8", seg(0xDB, b"\x00" + bytes(quant))]
    out.append(seg(0xC2, b"\x08" + height.to_bytes(2, "big") + width.to_bytes(2, "big") + bytes([len(comps)]) + b"".join(bytes((i, h << 4 | v, 0)) for i, h, v in comps)))
    dc_t, dc = table(0x00, list(range(12)))
    ac_t, ac = table(0x10, [r << 4 | s for r in range(16) for s in range(11)])
    out.append(seg(0xC4, dc_t + ac_t))
    head = lambda cs, a, b, hl: seg(0xDA, bytes((len(cs), *(x for c in cs for x in (c, 0)), a, b, hl)))
    order = [(c, (y * v + dy) * wide * h + x * h + dx) for y in range(high) for x in range(wide) for c, h, v in comps for dy in range(v) for dx in range(h)]
    if len(comps) == 1:
        order = [(1, y * wide * comps[0][1] + x) for y in range(-(-height // 8)) for x in range(-(-width // 8))]
    w, last = Writer(), dict.fromkeys(range(1, 4), 0)
    for c, r in order:
        d = (coefs[c - 1][r][0] >> 1) - last[c]
        last[c] = coefs[c - 1][r][0] >> 1
        w.put(*dc[abs(d).bit_length()])
        number(w, d)
    out += [head([c for c, _, _ in comps], 0, 0, 0x01), w.done()]
    for a, b, step in bands:
        for c, h, v in comps:
            own_w, own_h = -(-(-(-width * h // top_h)) // 8), -(-(-(-height * v // top_v)) // 8)
            rows = [y * wide * h + x for y in range(own_h) for x in range(own_w)]
            write = first if step == "first" else refine
            write(w, [coefs[c - 1][r] for r in rows], a, b, ac)
            out += [head([c], a, b, 0x01 if step == "first" else 0x10), w.done()]
    for c, r in order:
        w.put(coefs[c - 1][r][0] & 1, 1)
    out += [head([c for c, _, _ in comps], 0, 0, 0x10), w.done(), b"\xff\xd9"]
    return b"".join(out)


def end_of_band(w, run, ac):
    if run:
        n = run.bit_length() - 1
        w.put(*ac[n << 4])
        w.put(run - (1 << n), n)


def first(w, blocks, a, b, ac):
    run = 0
    for block in blocks:
        zeros = 0
        for k in range(a, b + 1):
            v = shift(block[k], 1)
            if not v:
                zeros += 1
                continue
            end_of_band(w, run, ac)
            run = 0
            while zeros > 15:
                w.put(*ac[0xF0])
                zeros -= 16
            w.put(*ac[zeros << 4 | abs(v).bit_length()])
            number(w, v)
            zeros = 0
        run += zeros > 0
    end_of_band(w, run, ac)


def refine(w, blocks, a, b, ac):
    run, held = 0, []
    for block in blocks:
        zeros, own = 0, []
        fresh = [k for k in range(a, b + 1) if abs(block[k]) == 1]
        for k in range(a, b + 1):
            v = block[k]
            if abs(v) > 1:
                own.append(abs(v) & 1)
                continue
            if not v:
                zeros += 1
                if zeros == 16 and k < max(fresh, default=0):
                    end_of_band(w, run, ac)
                    w.bits += held
                    run, held = 0, []
                    w.put(*ac[0xF0])
                    w.bits += own
                    zeros, own = 0, []
                continue
            end_of_band(w, run, ac)
            w.bits += held
            run, held = 0, []
            w.put(*ac[zeros << 4 | 1])
            w.put(v > 0, 1)
            w.bits += own
            zeros, own = 0, []
        if zeros or own:
            run += 1
            held += own
    end_of_band(w, run, ac)
    w.bits += held


def float_idct(block):
    c = lambda u: math.sqrt(0.125) if u == 0 else 0.5
    return [[sum(c(u) * c(v) * block[v][u] * math.cos((2 * x + 1) * u * math.pi / 16) * math.cos((2 * y + 1) * v * math.pi / 16) for u in range(8) for v in range(8)) for x in range(8)] for y in range(8)]


@pytest.mark.parametrize(("size", "samplings"), [((17, 25), [(1, 1)]), ((33, 20), [(2, 2), (1, 1), (1, 1)]), ((16, 24), [(2, 1), (1, 1), (1, 1)]), ((9, 9), [(1, 1), (1, 1), (1, 1)])])
def test_decodes_any_progressive_scans(size, samplings):
    rng = random.Random(size[0])
    width, height = size
    top_h, top_v = max(h for h, _ in samplings), max(v for _, v in samplings)
    wide, high = -(-width // (8 * top_h)), -(-height // (8 * top_v))
    coefs = [[[rng.randint(-200, 200)] + [rng.choice([0] * rng.choice([1, 40]) + [1, -1, 2, -3, 9, -40]) for _ in range(63)] for _ in range(wide * h * high * v)] for h, v in samplings]
    for c in coefs:
        c[0][1:] = [0] * 63
        c[-1][1:] = [0] * 62 + [1]
    data = encode(width, height, samplings, coefs, [(1, 5, "first"), (6, 63, "first"), (1, 63, "refine")], [k % 5 + 1 for k in range(64)])
    img = M.decode_coefficients(data)
    for c, (h, v) in enumerate(samplings):
        own_w, own_h = -(-(-(-width * h // top_h)) // 8), -(-(-(-height * v // top_v)) // 8)
        for y in range(own_h):
            for x in range(own_w):
                r = y * wide * h + x
                assert img.components[c].coef[r].tolist() == coefs[c][r], (c, r)
    rgb = M.to_rgb(img)
    assert rgb.shape == (height, width, 3)
    if len(samplings) == 1:
        block = np.zeros(64)
        block[M.ZIGZAG] = np.array(coefs[0][0]) * np.array([k % 5 + 1 for k in range(64)])
        want = np.clip(np.rint(np.array(float_idct(block.reshape(8, 8).tolist())) + 128), 0, 255)
        assert np.abs(rgb[:8, :8, 0].astype(int) - want).max() <= 1


def test_zigzag_is_the_diagonal_order():
    assert M.ZIGZAG.tolist()[:10] == [0, 1, 8, 16, 9, 2, 3, 10, 17, 24] and sorted(M.ZIGZAG.tolist()) == list(range(64))


@pytest.mark.parametrize("text", [None, "", "a", "x" * 64, "y" * 65, "ä漢🙂" * 50, "\x00\xff" * 300, "z" * 30_000])
def test_payload_round_trip(text):
    payload, n = M.payload_of(text)
    raw = (text or "").encode()
    assert payload == raw + b"\0" * (len(payload) - n) and len(payload) % 64 == 0 and len(payload) >= max(64, n) and len(payload) - n < 64 + (n == 0)
    img = M.decode_coefficients(M.encode_payload(payload, n))
    assert M.read_payload(img) == payload and img.comment.split()[0] == str(n).encode()
    assert img.scans == 11


def test_fast_scans_agree_with_symbol_by_symbol(monkeypatch):
    payload = bytes(range(256)) * 3
    data = M.encode_payload(payload, len(payload))
    fast = M.decode_coefficients(data)
    start = M._Huffman.__init__

    def slow(self, *args):
        start(self, *args)
        self.single = self.fixed = None

    monkeypatch.setattr(M._Huffman, "__init__", slow)
    plain = M.decode_coefficients(data)
    assert all(np.array_equal(a.coef, b.coef) for a, b in zip(fast.components, plain.components, strict=True))


def test_store(spark, odd, none):
    out = M.store(odd).collect()
    assert len(out) == odd.count()
    texts = {1: "The quick brown fox jumps over the lazy dog", 2: None, 5: "word " * 120_000}
    for r in out:
        if r["doc_id"] in texts:
            payload, n = M.payload_of(texts[r["doc_id"]])
            assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
            assert r["media_bytes"] == len(r["media"]) and hashlib.sha256(r["media"]).hexdigest() == r["media_sha256"]
            assert len(r["rgb"]) == r["height"] * r["width"] * 3 and M.feature_of(np.frombuffer(r["rgb"], np.uint8).reshape(r["height"], r["width"], 3)) == r["feature"]
    same = {(r["payload_sha256"], r["media_sha256"], r["feature"]) for r in out if r["doc_id"] in (2, 3)}
    assert len(same) == 1
    assert M.store(none).count() == 0


def test_broken_files_are_errors():
    for data in (b"", b"\x89PNG", b"\xff\xd8\xff\xc0" + b"\0\x0b\x08\0\x08\0\x08\x01\x01\x11\0"):
        with pytest.raises((ValueError, IndexError)):
            M.decode_coefficients(data)
