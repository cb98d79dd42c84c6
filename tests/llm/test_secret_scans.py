import hashlib
import re

from rillstone.llm import secret_scans
from rillstone.llm.common import table
from rillstone.session import shared_folder

NAMES = ("password", "passwd", "secret", "token", "api_?key")
WORD = "(?:" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in NAMES) + ")"
ASSIGN = re.compile(WORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain(t):
    t = t or ""
    out = [("assign", *m.span()) for m in ASSIGN.finditer(t) if len(m[1]) >= 6]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def expected(t):
    base = plain(t)
    digest = hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
    return (*[sum(x[0] == k for x in base) for k in ("assign", "access", "hex")], digest)


def got(rows):
    return sorted(((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in rows), key=str)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    docs = table(spark, folder, "documents").collect()
    assert got(secret_scans.op9_blob_ledger(spark, folder).collect()) == sorted(((r.doc_id, *expected(r.text)) for r in docs), key=str)


ODD = [
    None, "", "toKEN = 'abc' PASSWORD:abcdef secret==x", "api_key : \"A1b2C3+/=\" apiKey=zzzzzz ſecret=abcdefgh toKen=abcdefgh",
    "AKIA" + "A" * 15, "xAKIA" + "B1" * 8 + " AKIAAKIAAKIA", "g" + "0f" * 12 + "G " + "a" * 23, "token" * 2000, "token " + " " * 5000 + "=abcdef",
    "-----BEGIN RSA PRIVATE KEY-----é", "eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl",
]


def test_only_unseen_blobs_are_scanned(spark):
    ledger = shared_folder(spark, "ledger")
    rows = [(i, t, "v1", "x") for i, t in enumerate(ODD)] + [(0, None, "v1", "x"), (None, ODD[3], "v1", "y"), (50, ODD[3], "v2", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, version string, SPANS string")
    out = secret_scans.scan(df, ledger, path="doc_id", version="version")
    assert out.columns == ["doc_id", "version", "blob", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    assert got(out.collect()) == sorted(((r[0], *expected(r[1])) for r in rows), key=str)
    blobs = {r[1] or "" for r in rows}
    assert secret_scans.read_ledger(spark, ledger).count() == len(blobs)
    assert {r.doc_id: r.spans.split(":")[0] for r in out.collect() if r.doc_id in (9, 10)} == {9: "pem", 10: "jwt"}

    more = df.union(spark.createDataFrame([(77, "passwd=hunter22", "v3", ""), (78, ODD[5], "v3", "")], df.schema))
    again = {r[0]: r[1:4] for r in got(secret_scans.scan(more, ledger, path="doc_id", version="version").collect())}
    assert again[77] == (1, 0, 0) and again[78] == expected(ODD[5])[:3]
    assert secret_scans.read_ledger(spark, ledger).count() == len(blobs) + 1
    secret_scans.scan(more, ledger, path="doc_id", rules="3")
    assert secret_scans.read_ledger(spark, ledger).count() == 2 * (len(blobs) + 1)
    assert secret_scans.scan(df.limit(0), shared_folder(spark, "ledger"), path="doc_id").count() == 0
