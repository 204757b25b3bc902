import hashlib
import re
from collections import Counter

from recordlink.llm.op6_secrets import redact, secret_report, secret_scanner
from tests.llm.edge import edge_documents, empty_documents

SF = "/root/testdata/sf0.01"


def brute(text):
    out = []
    p = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for k, (kind, rx, ok) in enumerate((("assign", p, lambda m: len(m[2]) >= 8), ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
                                        ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 32))):
        out += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(rx, text or "") if ok(m)]
    return [x[2] for x in sorted(out)]


def _check(rows, docs):
    want = Counter()
    for d in docs:
        b = brute(d.text)
        want[d.doc_id, sum(x[:3] == "ass" for x in b), sum(x[:3] == "acc" for x in b), sum(x[:3] == "hex" for x in b),
             hashlib.sha256(",".join(b).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in rows) == want
    for r in rows:
        spans = r.spans.split(",") if r.spans else []
        base = [s for s in spans if not s.startswith("literal")]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256


def test_base_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = secret_report(docs).collect()
    _check(rows, docs.collect())
    assert sum(r.n_assign for r in rows) > 0


def test_edge(spark):
    extra = spark.createDataFrame([(50, "PASSWORD = 'short1' Token:abcdefgh12 é" + "a1" * 40 + " AKIA12 AKIA" + "Z9" * 8, "x"),
                                   (51, "apiKey=\"\" api_key : 'A-b_c/d.e=' paſſword=abcdefghijk toKen:x", "x")],
                                  "doc_id long, text string, lang string")
    docs = edge_documents(spark).select("doc_id", "text", "lang").unionByName(extra)
    _check(secret_report(docs).collect(), docs.collect())
    assert secret_report(empty_documents(spark)).count() == 0


def found(text):
    return {text[s:e] for kind, s, e, _ in secret_scanner()(text) if kind == "literal"}


def test_lexer_follows_assignments():
    assert found('k = "q8Zp!x2Lm9vT"\nother = k\ndb_password = other\n') == {"q8Zp!x2Lm9vT"}
    assert found('PRIVATE_KEY = "aZ9x" + "Qw3e" + "7Yt2"') == {"aZ9x", "Qw3e", "7Yt2"}
    assert found('{"client": {"signingKey": "mF9-2kd_83jdQz"}}') == {"mF9-2kd_83jdQz"}
    assert found("export ACCESS_KEY='u7Ghh29Xkq1'") == {"u7Ghh29Xkq1"}
    assert found("passphrase: tr0ub4dor&3xyz\n") == {"tr0ub4dor&3xyz"}
    assert found("cfg['credential'] = 'pL0s9!aQmn'") == {"pL0s9!aQmn"}
    assert found('passwd := `z8Kq1mX0pp`') == {"z8Kq1mX0pp"}


def test_lexer_leaves_harmless_values():
    for text in ('color = "q8Zp!x2Lm9vT"', 'password = "changeme"', 'password = "${DB_PASSWORD}"', "secret: please ask the admin",
                 "token == 'q8Zp!x2Lm9vT'", 'k = "q8Zp!x2Lm9vT"\nk = 5\nname = k', "the password: none of that matters",
                 "at 10:30 the ratio was 3:4", "key = value", "https://example.com/path?token"):
        assert found(text) == set(), text


def test_weak_names_report_full_scoring_literals():
    for name in ("key", "auth", "DB_PASS", "salt", "cert", "signature", "login", "dsn", "conn"):
        assert found(f"{name} = 'Xq9!r7LmZ2vTk'") == {"Xq9!r7LmZ2vTk"}, name
    assert found("auth: 'Xq9!r7LmZ2vTk'") == {"Xq9!r7LmZ2vTk"}
    assert found("dsn = 'postgres://app:u7Ghh2@db/main'") == {"postgres://app:u7Ghh2@db/main"}
    for text in ("DB_PASS = 'changeme'", "key = 'colour'", "auth: 'basic'", "login = 'aaaaaaaaaaaa1'"):
        assert found(text) == set(), text


def test_strong_words_inside_joined_names():
    for name in ("dbpassword", "authtoken", "clientsecret", "DBPASSWORD", "awssecretkey", "userpwd", "refreshtokens",
                 "app.dbpassword", "tokenvalue", "encryptionkey", "secretid", "tokenissuer"):
        assert found(f"{name} = 'q8!p#x2Lm'") == {"q8!p#x2Lm"}, name
    for name in ("tokenizer", "secretary", "tokenization", "secretion", "monkey", "compass"):
        assert found(f"{name} = 'q8!p#x2Lm9vT'") == set(), name


def test_pass_phrases_with_spaces():
    for name in ("passphrase", "pass_phrase", "sshPassPhrase", "keypassphrase"):
        assert found(f'{name} = "correct horse battery staple"') == {"correct horse battery staple"}, name
    for text in ('passphrase: "Enter the passphrase"', 'password: "correct horse battery staple"',
                 'title = "correct horse battery staple"', 'compass_phrase = "correct horse battery staple"',
                 "passphrase: none of that matters"):
        assert found(text) == set(), text


def test_report_and_redact_weak_names(spark):
    docs = spark.createDataFrame([(1, "DB_PASS = 'Xq9!r7LmZ2vTk'"), (2, 'passphrase = "correct horse battery staple"'),
                                  (3, "dbpassword = 'q8!p#x2Lm'")], "doc_id long, text string")
    assert {(r.doc_id, r.n_literal) for r in secret_report(docs).collect()} == {(1, 1), (2, 1), (3, 1)}
    assert {(r.doc_id, r.text) for r in redact(docs).collect()} == {
        (1, "DB_PASS = '[secret]'"), (2, 'passphrase = "[secret]"'), (3, "dbpassword = '[secret]'")}


def test_positions_are_code_points():
    text = "東京 é 😀 my_secret = 'q8Zp!x2Lm9vT'"
    assert [(text[s:e]) for k, s, e, _ in secret_scanner()(text) if k == "literal"] == ["q8Zp!x2Lm9vT"]


def test_redact(spark):
    docs = edge_documents(spark).select("doc_id", "text", "kind").unionByName(
        spark.createDataFrame([(77, "a password=b7db7aa4a5fcc78305b7db7aa4a5fcc78305 z", "q")], "doc_id long, text string, kind string"))
    out = redact(docs)
    assert out.columns == docs.columns
    got = Counter((r.doc_id, r.text, r.kind) for r in out.collect())
    want = Counter((r.doc_id, "a [secret] z" if r.doc_id == 77 else r.text, r.kind) for r in docs.collect())
    assert got == want


def test_time_grows_with_the_text():
    import time
    from recordlink.llm.op6_secrets import secret_scanner
    scan = secret_scanner()
    for piece in ("x=", "a-b.c:", "a = a + a\n", "password = password + 'q7W8e9R0'\n", "k:v ", "token='q7W8e9R0',"):
        took = []
        for n in (4_000, 16_000):
            text = 'a = "Zz9x"\n' + piece * (n // len(piece))
            t = time.perf_counter()
            scan(text)
            took.append(time.perf_counter() - t)
        assert took[1] < 10 * took[0] + 0.5, piece
    # a self-joining constant names its literal once
    found = scan('k = "q7W8e9R0t1Y2"\n' + "k = k + k\n" * 1000 + "password = k\n")
    assert [(kind, s, e) for kind, s, e, _ in found] == [("literal", 5, 17)]
