"""Secret scans with assignment-aware lexing.

Base kinds are found by pattern: ``assign`` (a key word, ``=`` or ``:``, a value of 8 or more
characters), ``access`` (``AKIA`` identifiers) and ``hex`` (32 or more hexadecimal digits).

The lexer then reads the text as source or configuration: around every ``=``, ``:``, ``:=`` or
``=>`` it takes the target name before it (plain, quoted, dotted or indexed) and the expression
after it: quoted strings, bare words, names, joined by ``+`` or ``.`` . Literals are bound to
names and constants are propagated: ``a = "..."; b = a; password = b`` reports the literal where
it stands; a name is bound to the pieces of its expression, not to a copy of what they hold. The
text is read once: a run of characters without a blank is measured once, however many operators
stand in it, and only literals bound to sensitive names are looked at. A literal's make-up (length, mixture, entropy, placeholders) gives 0 to 1 in quarters;
a strong target name (``password``, ``token``, also inside a joined name such as ``dbpassword``)
adds 0.25, a weak one (``key``, ``auth``, ``pass``, ``dsn``; whole name parts) adds nothing, other
names are not scored. From ``threshold`` on, by default 1, the span is reported as ``literal``:
under a strong name at a make-up of 0.75, under a weak one at a full 1. Quoted values with spaces
count under pass-phrase names only, and not if they read as a prompt; unquoted words without a
digit are prose.

Whole texts are scanned, positions are code points, end exclusive. Edge cases: a null text is
empty and has no span; empty texts, null ids and repeated rows give one result each; empty
tables give no rows; other columns pass through ``with_findings``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlink.llm.common import arrow_schema, give_back, worker_held

BASE_KINDS = ["assign", "access", "hex"]
KINDS = [*BASE_KINDS, "literal"]
FINDINGS = "_llm_findings"
FINDING = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def secret_scanner(threshold: float = 1.0):
    """A function text -> [(kind, start, end, score)], ordered by start, then kind as listed."""
    import math
    import re
    from collections import Counter

    # The base patterns.
    assign = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                        re.ASCII)
    access = re.compile(r"AKIA[A-Z0-9]+")
    hexa = re.compile(r"[0-9a-f]{32,}")     # a run of [0-9a-f]+ is one match; short runs fail
    key_words = ("password", "passwd", "secret", "token", "apikey", "api_key")

    operator = re.compile(r":=|=>|(?<![=!<>:+\-*/%&|^])=(?![=>~])|:(?![:/=])")
    name_end = re.compile(r"""(?:\[\s*)?(["']?)([A-Za-z_$][\w$.\-]*)\1(?:\s*\])?[\x20\t]*(?::\s*[A-Za-z_][\w\[\]]*[\x20\t]*)?$""")
    blank = re.compile(r"[\x20\t]*")
    string = re.compile(r'''"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`''')
    run_end = re.compile(r"[\s\"'`,;(){}\[\]<>#]")       # a bare word ends before one of these
    name_part = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_$.-\"'[]\x20\t:")
    plus = re.compile(r"[\x20\t]*(?:\+|\.\.?(?=[\x20\t]*[\"'A-Za-z_]))[\x20\t]*(?:\\?\n[\x20\t]*)?")
    ident = re.compile(r"[A-Za-z_$][\w$]*(?:\.[A-Za-z_$][\w$]*)*")
    part = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
    strong = {"password", "passwd", "pwd", "passphrase", "secret", "secrets", "token", "credential", "credentials",
              "apikey", "privatekey", "accesskey", "authkey", "signingkey", "bearer"}
    pairs = {("api", "key"), ("private", "key"), ("access", "key"), ("secret", "key"), ("auth", "key"),
             ("encryption", "key"), ("signing", "key"), ("master", "key"), ("pass", "word"), ("pass", "phrase"),
             ("connection", "string")}
    # Strong words and pairs inside one part of a joined name; tokenizer, secretary and the like are other words.
    inner = "|".join(sorted(strong - {"token", "secret"} | {a + b for a, b in pairs}, key=len, reverse=True))
    joined = re.compile(rf"{inner}|token(?!i[sz](?:e|ing|ation))|secret(?!ar[iy]|e[ds]?$|i(?:ng|on|ve)|ory?$|ly$)")
    phrase = re.compile(r"passphrase|(?<![a-z])pass_phrase")
    prompt = re.compile(r"(?i)\b(?:enter|type|please|your|pass[\s_-]?(?:phrase|word)s?)\b")
    weak = {"key", "auth", "pass", "salt", "cert", "signature", "login", "dsn", "conn"}
    dummy = re.compile(r"(?i)^(?:change_?me|example|placeholder|redacted|dummy|sample|test|none|null|true|false|"
                       r"undefined|todo|your[_\-].*|my[_\-].*|x+|\*+|\.+|-+|<.*>|\$\{.*\}|\{\{.*\}\}|%\w+%|\$\w+)$")

    def name_score(name: str) -> float | None:
        """What the name adds to a literal's score; None: the name is not sensitive."""
        words = [w.lower() for w in part.findall(name)]
        if any(joined.search(w) for w in words) or any(p in pairs for p in zip(words, words[1:])):
            return 0.25
        return 0.0 if weak.intersection(words) else None

    def literal_score(value: str, spaces: bool, counts: Counter | None = None) -> float:
        """0 to 1; ``spaces``: the target holds a pass phrase, so the value may have spaces."""
        if len(value) < 6 or dummy.match(value):
            return 0.0
        counts = counts or Counter(value)
        if any(c.isspace() for c, k in counts.items() if k) and (not spaces or prompt.search(value)):
            return 0.0
        n = len(value)
        bits = -sum(k / n * math.log2(k / n) for k in counts.values() if k)
        kinds = len({"a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else "0" if "0" <= c <= "9" else "-" for c, k in counts.items() if k})
        return 0.25 * (kinds >= 2) + 0.25 * (n >= 8) + 0.25 * (bits >= 2.5) + 0.25 * (bits >= 3.2 or n >= 20)

    def counter_of(text: str):
        """A function span -> character counts; of spans with one end, each is counted from the one before."""
        last: list = [0, -1, None]

        def counts(start, end):
            if end == last[1] and start >= last[0]:
                last[2].subtract(text[last[0]:start])
                last[0] = start
            else:
                last[:] = start, end, Counter(text[start:end])
            return last[2]

        return counts

    def bare_words(text: str):
        """A function place -> (end of the bare word there, whether it has a digit). A run is measured once."""
        known = [-1, -1, -1, -1]            # start and end of the last run, its last digit, its last plus but one at the end

        def read(at):
            if at >= len(text) or text[at] == "+" or run_end.match(text, at):
                return at, False
            if not known[0] <= at < known[1]:
                m = run_end.search(text, at)
                end = m.start() if m else len(text)
                last = end - 1
                while last >= at and not text[last].isdigit():
                    last -= 1
                known[:] = at, end, last, text.rfind("+", at, end - 1)
            end = known[1]
            if text[end - 1] == "+" and known[3] < at:         # a lone plus at the end joins what follows
                end -= 1
            return end, known[2] >= at

        return read

    def expression(text: str, at: int, names: dict, word) -> tuple[list, int]:
        """Pieces of the expression at ``at``, literals (start, end) or what a name is bound to, and its end."""
        found: list = []
        while True:
            at = blank.match(text, at).end()
            m = string.match(text, at)
            if m:
                found.append((m.start(m.lastindex), m.end(m.lastindex)))
                at = m.end()
            else:
                m = ident.match(text, at)
                if m and m[0] in names:
                    found.append(names[m[0]])
                    at = m.end()
                else:
                    stop, digit = word(at)
                    if stop == at:
                        break
                    end = stop
                    while end > at and text[end - 1] in ".,;:!?":
                        end -= 1
                    if end > at and digit:          # a bare word without a digit is prose or a name
                        found.append((at, end))
                    at = stop
            m = plus.match(text, at)
            if not m:
                break
            at = m.end()
        return found, at

    def spans_of(found: list) -> list[tuple[int, int]]:
        """The literals that pieces reach, each once, in order."""
        seen, spans, stack = set(), {}, [found]
        while stack:
            piece = stack.pop()
            if isinstance(piece, tuple):
                spans.setdefault(piece)
            elif id(piece) not in seen:
                seen.add(id(piece))
                stack += reversed(piece)
        return list(spans)

    def named_literals(text: str):
        """Sensitive targets in text order, constants propagated: (target name, what it adds, its literals)."""
        names: dict[str, list] = {}
        word = bare_words(text)
        for m in operator.finditer(text):
            # back over what a target can be: a name, and one colon before its type
            low, colons = m.start(), 0
            while low and m.start() - low < 512 and (c := text[low - 1]) in name_part or low and c.isalnum():
                colons += c == ":"
                if colons > 1:
                    break
                low -= 1
            t = name_end.search(text, low, m.start())
            if not t:
                continue
            found, _ = expression(text, m.end(), names, word)
            if not found:
                continue
            names[t[2]] = found
            score = name_score(t[2])
            if score is not None:
                yield t[2], score, spans_of(found)

    def scan(text: str | None) -> list[tuple[str, int, int, float]]:
        if not text:
            return []
        out = []
        if "=" in text or ":" in text:
            low = text.lower()
            if any(w in low for w in key_words):
                out += [("assign", m.start(), m.end(), 1.0) for m in assign.finditer(text) if len(m[2]) >= 8]
            best: dict[tuple[int, int], float] = {}
            counts = counter_of(text)
            for name, score, spans in named_literals(text):
                phrases = bool(phrase.search("_".join(part.findall(name)).lower()))
                one = counts(*spans[0]) if len(spans) == 1 else None
                score += literal_score("".join(text[a:b] for a, b in spans), phrases, one)
                if score >= threshold:
                    for a, b in spans:
                        if b > a:
                            best[a, b] = max(score, best.get((a, b), 0.0))
            out += [("literal", s, e, x) for (s, e), x in best.items()]
        if "AKIA" in text:
            out += [("access", m.start(), m.end(), 1.0) for m in access.finditer(text) if len(m[0]) >= 16]
        out += [("hex", m.start(), m.end(), 1.0) for m in hexa.finditer(text)]
        return sorted(out, key=lambda f: (f[1], KINDS.index(f[0]), f[2]))

    return scan


def with_findings(docs: DataFrame, text_col: str = "text", threshold: float = 1.0) -> DataFrame:
    """``docs`` with the array of findings; all columns pass through."""
    schema = docs.select("*", F.lit(None).cast(FINDING).alias(FINDINGS)).schema
    at = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa
        scan, target = secret_scanner(threshold), arrow_schema(schema)
        kind = target.field(target.names.index(FINDINGS)).type
        for b in batches:
            rows = [[dict(zip(("kind", "start", "end", "score"), f)) for f in scan(t)]
                    for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, kind)], names=target.names)

    return docs.mapInArrow(run, schema)


def _joined(kinds: list[str] | None = None) -> Column:
    spans = F.col(FINDINGS)
    if kinds:
        spans = F.filter(spans, lambda f: f.kind.isin(kinds))
    return F.array_join(F.transform(spans, lambda f: F.concat_ws(":", f.kind, f.start.cast("string"),
                                                                 f.end.cast("string"))), ",")


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: numbers of base findings, the digest of the base spans and all spans."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def number(kind: str) -> Column:
        return F.size(F.filter(FINDINGS, lambda f: f.kind == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(k) for k in KINDS]
    return with_findings(narrow).select(
        "doc_id", *counts[:3], F.sha2(_joined(BASE_KINDS), 256).alias("base_sha256"), _joined().alias("spans"),
        counts[3])


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every finding's span replaced by ``mark`` (overlapping spans once); a
    null text stays null. Same columns."""
    schema, at = docs.schema, docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa
        scan, target = secret_scanner(), arrow_schema(schema)
        worker_held()

        def clean(text):
            found, out, done = scan(text), [], 0
            for _, s, e, _ in found:
                if s >= done:
                    out += [text[done:s], mark]
                done = max(done, e)
            return "".join([*out, text[done:]]) if found else text

        for b in batches:
            for lo in range(0, b.num_rows, 512):
                cols = list(b.slice(lo, 512).columns)
                cols[at] = pa.array([clean(t) for t in cols[at].to_pylist()], target.field(at).type)
                yield pa.RecordBatch.from_arrays(cols, names=target.names)
        give_back()

    return docs.mapInArrow(run, schema)


def redact_documents(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``redact``, with the length column (if there is one) set to the new text's where it was set."""
    out = redact(docs, text_col)
    if length_col not in docs.columns:
        return out
    new = F.when(F.col(length_col).isNotNull(), F.char_length(text_col)).cast(docs.schema[length_col].dataType)
    return out.withColumn(length_col, new)
