import base64
import bz2
import gzip
import lzma
import random
import re
import subprocess
import sys
import urllib.parse
import zlib

import zstandard

from navspark.llm import secrets as S

BASE = [
    re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    re.compile(r"AKIA[A-Z0-9]+"),
    re.compile(r"[0-9a-f]+"),
]


def plain(text):
    out = [(m.start(), 0, m.end()) for m in BASE[0].finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in BASE[1].finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in BASE[2].finditer(text) if len(m[0]) >= 24]
    return sorted(out)


def test_base_equals_plain_patterns(documents):
    rnd = random.Random(2)
    parts = ["password", "TOKEN", "api_key", "apikey", "=", ":", '"', " ", "abc", "token", "AKIA", "0123456789abcdef", "ABCDEFGH12345678", "é", "K", "ſecret"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(30))) for _ in range(3000)] + [r.text for r in documents.collect()]
    for t in texts:
        assert S.scan(t) == plain(t)
        base, found = S.secrets(t)
        assert base == plain(t) and set(base) <= set(found)


def layers(secret):
    raw = secret.encode()
    b64 = lambda x: base64.b64encode(x).decode()
    yield b64(raw)
    yield base64.urlsafe_b64encode(raw).decode().rstrip("=")
    yield "".join(f"%{b:02x}" for b in raw)
    yield "".join(f"\\u{ord(c):04x}" for c in secret)
    yield "".join(f"\\x{ord(c):02x}" for c in secret)
    for pack in (gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress):
        yield b64(pack(raw))
    yield b64(gzip.compress(urllib.parse.quote(b64(raw)).encode()))
    yield urllib.parse.quote(urllib.parse.quote(b64(b64(raw).encode()), safe=""), safe="")


def test_nested_layers_are_found_in_place():
    for coded in layers('password = "hunter2hunter2"'):
        text = f"é some words {coded} and more"
        base, found = S.secrets(text)
        start, kind, end = next(s for s in found if s[1] == 0)
        assert base == [] and kind == 0
        assert 13 <= start and end <= len(text) - 9 and end - start >= 0.7 * len(coded)


def test_compression_inside_compression_and_many_members():
    packs = (gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress)
    raw = b'password = "hunter2hunter2"'
    packed = [outer(inner(raw)) for outer in packs for inner in packs] + [gzip.compress(bz2.compress(zstandard.compress(raw)))]
    packed += [pack(b"nothing here ") + pack(b"") + pack(raw) for pack in packs] + [gzip.compress(b"pass") + zstandard.compress(b"word=hunt") + bz2.compress(b"er2hunter2")]
    packed += [gzip.compress(raw) + b"\x00" * 20, zstandard.compress(raw) + b"x" * 600, gzip.compress(zstandard.compress(b"and ") + gzip.compress(raw))]
    for data in packed:
        coded = base64.b64encode(data).decode()
        base, found = S.secrets(f"words {coded} more")
        assert base == [] and (6, 0, 6 + len(coded)) in found


def test_bytes_behind_escapes_and_odd_base64():
    secret = 'password = "hunter2hunter2"'
    raw = secret.encode()
    b64 = lambda x: base64.b64encode(x).decode()
    lines = base64.encodebytes(b"some words before it, then " + raw + b" and some words after it, to fill the lines").decode().strip()
    packed = gzip.compress(raw)
    cases = [
        urllib.parse.quote(packed), "".join(f"%{b:02x}" for b in packed), urllib.parse.quote(zlib.compress(raw)),
        "".join(f"\\x{b:02x}" for b in packed), repr(packed)[2:-1], repr(zlib.compress(raw))[2:-1],
        b64("café ".encode("latin-1") + raw), b64(secret.encode("utf-16")), b64(secret.encode("utf-16-be")), b64(secret.encode("utf-16-le")),
        b64(b"\x01" + raw), b64(raw + b"\x00"), lines, lines.replace("\n", "\r\n  "), base64.encodebytes(gzip.compress(raw * 9)).decode().strip(),
        *(f"{'blob/x-y_z'[:k]}/{b64(raw)}" for k in range(1, 10)), f"https://x.io/{b64(packed)}", f"id-{b64(zlib.compress(raw))}", f"id_{b64(raw)}",
        "".join(f"%{b:02x}" for b in secret.encode("utf-16-le")), "".join(f"\\x{b:02x}" for b in secret.encode("utf-16-be")),
    ]
    for coded in cases:
        text = f"é some words {coded} and more"
        base, found = S.secrets(text)
        assert base == [] and any(k == 0 and 13 <= i < j <= len(text) - 9 for i, k, j in found), coded


def test_random_chains_of_layers():
    """Whatever is wrapped, and however often, comes out."""
    rnd = random.Random(6)
    to_text = [
        lambda x: base64.b64encode(x).decode(), lambda x: base64.urlsafe_b64encode(x).decode(), lambda x: base64.encodebytes(x).decode().strip(),
        lambda x: "".join(f"%{b:02X}" for b in x), lambda x: "".join(f"\\x{b:02x}" for b in x), lambda x: "blob/" + base64.b64encode(x).decode(),
    ]
    to_bytes = [gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress, lambda x: x]
    for _ in range(300):
        data, names = b'token: "abcdef123456"', []
        for _ in range(rnd.randrange(1, 4)):
            i, j = rnd.randrange(6), rnd.randrange(6)
            data = to_text[j](to_bytes[i](data)).encode()
            names.append((i, j))
        text = f"x {data.decode()} y"
        base, found = S.secrets(text)
        assert any(kind == 0 for _, kind, _ in found), names


def test_large_unpacked_data_in_bounded_memory():
    filler = b"nothing to see here, " * (1 << 20)
    for tail in (b'password = "hunter2hunter2"', gzip.compress(b'password = "hunter2hunter2"')):
        coded = base64.b64encode(gzip.compress(filler[: S.CHUNK * 2 - 13] + tail)).decode()
        assert any(k == 0 for _, k, _ in S.secrets(f"words {coded} more")[1])
    damaged = base64.b64encode(gzip.compress(b'password = "hunter2hunter2"' + filler[:100_000])[:-40]).decode()
    assert any(k == 0 for _, k, _ in S.secrets(damaged)[1])


def wrapped_long(raw):
    """Encodings of ``raw``, incompressible, each longer than the overlap of chunks."""
    b64 = lambda x: base64.b64encode(x)
    yield gzip.compress(raw)
    yield zstandard.compress(raw)
    yield b64(gzip.compress(raw))
    yield b"x-" + b64(zlib.compress(raw)) + b"."
    yield base64.encodebytes(lzma.compress(raw))
    yield "".join(f"%{b:02x}" for b in bz2.compress(raw)).encode()
    yield "".join(f"\\x{b:02x}" for b in gzip.compress(raw)).encode()
    yield urllib.parse.quote(b64(b64(gzip.compress(raw))).decode(), safe="").encode()
    yield "".join(f"\\u{b:04x}" for b in b64(gzip.compress(raw))).encode()
    yield b64(gzip.compress(raw)).decode().encode("utf-16-le")
    yield b64(gzip.compress(b64(gzip.compress(raw))))


def test_long_runs_over_the_edges_of_chunks(monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 64 << 10)
    monkeypatch.setattr(S, "OVERLAP", 4 << 10)
    rnd = random.Random(5)
    raw = "".join(rnd.choices("ghijklmnopqrstuvwxyzGHIJ,.;!?& ", k=98_000)).encode() + b"\npassword = hunter2hunter2"
    for k, coded in enumerate(wrapped_long(raw)):
        for before in (0, 40_000, 63_003):
            packed = gzip.compress(b"word, " * (before // 6) + b";" * (before % 6) + coded + b" the end, " * 900)
            text = "words " + base64.b64encode(packed).decode() + " more"
            assert any(kind == 0 and (i, j) == (6, len(text) - 5) for i, kind, j in S.secrets(text)[1]), (k, before)


def peak_mb(megabytes):
    """Peak memory of a new process that scans base64(gzip) of so many MB of differing lines."""
    code = (
        "import base64, resource, sys, zlib\n"
        "from navspark.llm import secrets as S\n"
        "c, out = zlib.compressobj(9, wbits=31), []\n"
        "for k in range(int(sys.argv[1]) * 16):\n"
        "    out.append(c.compress(f'{k}, '.encode() + b'nothing, ' * 7280))\n"
        "out += [c.compress(b'password = \"hunter2hunter2\"'), c.flush()]\n"
        "found = S.secrets('words ' + base64.b64encode(b''.join(out)).decode())[1]\n"
        "assert any(k == 0 for _, k, _ in found), found\n"
        "print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)\n"
    )
    return int(subprocess.run([sys.executable, "-c", code, str(megabytes)], capture_output=True, text=True, check=True).stdout)


def test_memory_does_not_grow_with_unpacked_size():
    assert peak_mb(60) < 1.2 * peak_mb(20)


def test_deep_chains_and_a_file_that_unpacks_to_itself_in_part():
    raw = b'password = "hunter2hunter2"'
    for _ in range(150):
        raw = gzip.compress(raw)
    assert any(k == 0 for _, k, _ in S.secrets(base64.b64encode(raw).decode())[1])


def test_percent_u_escapes():
    secret = "token=abcdef123"
    text = "é " + "".join(f"%u{ord(c):04x}" for c in secret) + " more"
    assert S.secrets(text)[1] == [(2, 0, 2 + 6 * len(secret))]


def test_partly_escaped_text_maps_back():
    assert S.secrets("x pass%77ord%3Dabcdefg.")[1] == [(2, 0, 23)]
    assert S.secrets("%61" * 24)[1] == [(0, 2, 72)]


def test_cycles_and_junk_end():
    for text in ("%" * 5000, "%25" * 3000 + "41", "\\u005c" * 500, "A" * 100_000, "%%%de %zz \\u12", base64.b64encode(b"\x1f\x8b" + b"x" * 40).decode(), "\\u{110000}\\ud800"):
        S.secrets(text)


def test_odd_rows(odd, nothing):
    rows = {r.doc_id: r for r in S.scan_secrets(odd).collect()}
    assert rows[3].spans == "" and rows[3].base == "" and rows[3].n_assign == 0 and len(rows) == 10
    assert S.scan_secrets(odd).count() == odd.count() and S.scan_secrets(nothing).count() == 0
