"""Personal data: fixed base patterns, and a semi-Markov conditional random field for other spellings.

Base kinds are found by pattern (``email``, ``ip``, ``card``, ``phone``). The field finds the same
kinds as people write them otherwise: ``ann (at) example dot org``, ``10[.]0[.]0[.]7``,
``(030) 555-0199``, ``3782.822463.10005``. It labels *segments*, not tokens: a candidate of at
most ``MOST_TOKENS`` tokens is scored by features of the whole span (digits, groups and their
lengths, separators, check digit, number range of the parts, kind of at and dots, the characters
and cue words around it) plus a transition from the label before it, and a dynamic program over the
ends of segments chooses boundaries and types jointly. Since segments are bounded, it takes time in
proportion to the text. A segment of the best path is added unless it meets a base span; base spans
always stay.

The field is trained here, by gradient ascent on the exact conditional likelihood (forward and
backward sums over all segmentations, 200 steps from zero weights): on spellings generated with a
fixed seed, set among words of the corpus, on near misses (dates, versions, prices, numbers whose
check digit is wrong) and on the base matches and failed base matches of about ``sample_rows`` rows
chosen by a hash of their texts (at most twice as many; 300 windows of them at most). No more than
this bounded sample reaches the driver; every text is scanned whole.

Positions are code points, end exclusive. Edge cases: a null text is empty and has no span; empty
texts, null ids and repeated rows give one result each; numbers of any length are read in one pass;
an empty table trains on the generated spellings alone and gives no rows; other columns are ignored
by ``personal_report`` and pass through ``redact_personal``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone"]
MOST_TOKENS = 24
CONTEXT = 3         # tokens kept on either side of a candidate


def base_finder():
    """A function text -> {kind: [(start, end)]} of the base patterns, each in one pass."""
    import re
    # The base patterns, cut at their first character or separator.
    local = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
    domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    dotted = re.compile(r"[0-9]+(?:\.[0-9]+)*")
    number = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
    phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    digits = re.compile(r"[^0-9]+")
    some_digit = re.compile(r"[0-9]")

    def emails(text):
        out, done, at = [], 0, text.find("@")
        while at >= 0:
            start = at
            while start > done and text[start - 1] in local:
                start -= 1
            m = domain.match(text, at + 1) if start < at else None
            if m:
                out.append((start, m.end()))
                done = m.end()
            at = text.find("@", max(at + 1, done))
        return out

    def small(part):
        part = part.lstrip("0")
        return len(part) < 4 and int(part or "0") <= 255

    def ips(text):
        out = []
        for m in dotted.finditer(text):
            if m[0].count(".") < 3:
                continue
            parts, at = m[0].split("."), m.start()
            for i in range(0, len(parts) - 3, 4):       # a match takes four parts, the next starts behind it
                four = parts[i:i + 4]
                size = sum(map(len, four)) + 3
                if all(map(small, four)):
                    out.append((at, at + size))
                at += size + 1
        return out

    def cards(text):
        return [m.span() for m in number.finditer(text) if len(m[0]) >= 16
                and 16 <= len(d := digits.sub("", m[0])) <= 19 and luhn(d)]

    def phones(text):
        return [m.span() for m in phone.finditer(text) if 8 <= len(digits.sub("", m[0])) <= 15]

    def find(text):
        if not text:
            return {k: [] for k in KINDS}
        numbers = some_digit.search(text)
        return {"email": emails(text) if "@" in text else [], "ip": ips(text) if numbers else [], "card": cards(text) if numbers else [],
                "phone": phones(text) if numbers and "+" in text else []}

    return find


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(c)] for c in digits[-2::-2])) % 10 == 0


def span_reader():
    """Functions ``windows(text)`` -> [(start, end)] around possible spans, ``tokens(text, start, end)``
    and ``segments(text, tokens)`` -> [(first, last + 1, kinds, features)]."""
    import re
    from bisect import bisect_right
    token = re.compile(r"[0-9]+|[^\W\d_]+|[^\s]")
    chain = re.compile(r"\+?[(\[]?[0-9](?:[\x20().\[\]+/-]{0,4}[0-9])+")
    at_word = [re.compile(rf"{w}(?![^\W_])[)\]}}>]?\x20{{0,2}}(?=[\w-]{{1,63}}[\x20(\[{{<]{{0,3}}(?:\.\w|dot\b|DOT\b|\.[)\]}}>]))") for w in ("at", "At", "AT")]
    some_digit = re.compile(r"[0-9]")
    joints = frozenset("().[]+/-")
    near = {"(": ")", "[": "]", "{": "}", "<": ">"}
    cues = {**dict.fromkeys(("tel", "phone", "call", "fon", "telefon", "mobile", "mobil", "cell", "fax", "dial", "ring", "whatsapp"), "phone"),
            **dict.fromkeys(("card", "visa", "mastercard", "amex", "kreditkarte", "carte", "tarjeta", "cc"), "card"),
            **dict.fromkeys(("ip", "host", "server", "address", "gateway", "ping", "subnet", "dns"), "ip"),
            **dict.fromkeys(("mail", "email", "contact", "write", "to"), "email"),
            **dict.fromkeys(("version", "v", "isbn", "no", "nr", "id", "order", "date", "page", "ref", "invoice", "section", "release"), "other")}

    def windows(text, known=()):
        """Lines, or parts of them, that may hold a span outside the ``known`` ones."""
        starts, ends = [a for a, _ in known], [b for _, b in known]

        def is_known(lo, hi):
            k = bisect_right(starts, lo) - 1
            return k >= 0 and hi <= ends[k]

        out = []
        for m in chain.finditer(text) if some_digit.search(text) else ():
            if is_known(*m.span()):
                continue
            digits = sum(c.isdigit() for c in m[0]) if len(m[0]) < 4096 else 7
            if digits >= 7 or ("[" in m[0] or " . " in m[0]) and digits >= 4:
                out.append((max(0, m.start() - 40), min(len(text), m.end() + 24)))
        marks = [at for at in _places(text, "@") if not is_known(at, at + 1)]
        for words in at_word:
            marks += [m.start() for m in words.finditer(text) if not (m.start() and text[m.start() - 1].isalnum())]
        out += [(max(0, at - 120), min(len(text), at + 160)) for at in marks]
        out.sort()
        merged = []
        for lo, hi in out:
            if merged and lo <= merged[-1][1]:
                merged[-1][1] = max(hi, merged[-1][1])
            else:
                merged.append([lo, hi])
        # a window starts and ends between tokens; no segment passes a line's end
        lines = []
        for lo, hi in merged:
            lo, hi = lo - _run(text, lo, -1), hi + _run(text, hi, 1)
            while (cut := text.find("\n", lo, hi)) >= 0:
                lines.append((lo, cut))
                lo = cut + 1
            lines.append((lo, hi))
        return [x for x in lines if x[1] - x[0] > 5]

    def _places(text, mark):
        at = text.find(mark)
        while at >= 0:
            yield at
            at = text.find(mark, at + 1)

    def _run(text, at, step):
        """How far the letters or digits that a cut at ``at`` divides reach, 200 at most."""
        n = 0
        if 0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum():
            while n < 200 and 0 <= (i := at - 1 - n if step < 0 else at + n) < len(text) and text[i].isalnum():
                n += 1
        return n

    def tokens(text, lo, hi):
        return [(m[0], m.start(), m.end()) for m in token.finditer(text, lo, hi)]

    def side(text, at, step):
        """Class of the character next to a span."""
        if not 0 <= at < len(text):
            return "end"
        c = text[at]
        if c.isspace():
            return "space"
        if c.isdigit():
            return "digit"
        if c.isalpha():
            return "letter"
        if c in ".,;:!?":       # a full stop, or a point inside a longer number
            far = at + step
            return "stop" if not 0 <= far < len(text) or not text[far].isdigit() else "point"
        return c if c in "-/+=#$%_@" else "mark"

    def around(text, toks, i, j):
        lo, hi = toks[i][1], toks[j - 1][2]
        out = [f"left {side(text, lo - 1, -1)}", f"right {side(text, hi, 1)}"]
        for t in reversed(toks[max(0, i - 3):i]):
            if cue := cues.get(t[0].lower()):
                out.append(f"cue {cue}")
                break
        return out

    def numbers(text, toks):
        for i, (t, lo, _) in enumerate(toks):
            if not (t[0] in "0123456789" or t in ("+", "(")):
                continue
            groups, seps, sep, digits = [], [], "", 0
            for j in range(i, min(len(toks), i + MOST_TOKENS)):
                u, a, b = toks[j]
                gap = text[toks[j - 1][2]:a] if j > i else ""
                if len(gap) > 2 or "\n" in gap or not (u[0] in "0123456789" or u in joints):
                    break
                sep += " " if gap else ""
                if u[0] not in "0123456789":
                    sep += u
                    if len(sep) > 5:
                        break
                    continue
                if groups:
                    seps.append(sep)
                lead = lead if groups else sep
                sep = ""
                groups.append(u)
                digits += len(u)
                if digits > 19 or len(groups) > 8:
                    break
                if digits >= 4 and (digits >= 7 or len(groups) == 4) and (j + 1 == len(toks) or toks[j + 1][1] > b or toks[j + 1][0][0] not in "0123456789"):
                    yield i, j + 1, _number_features(groups, seps, lead) + around(text, toks, i, j + 1)

    def _number_features(groups, seps, lead):
        d, sizes, whole = sum(map(len, groups)), [len(g) for g in groups], "".join(groups)
        plain = {s.strip() or s for s in seps}
        f = ["number", f"digits {d}", f"groups {min(len(groups), 6)}", f"sizes {'-'.join(map(str, sizes))}" if len(sizes) < 6 else "sizes many",
             f"lead {lead}", f"first {whole[0]}" if whole[0] in "012" else "first other"]
        f.append("no separator" if not plain else f"separator {plain.pop()}" if len(plain) == 1 else "separators " + " ".join(sorted(plain)))
        if lead == "(" or any(")" in s for s in seps):
            f.append("area code" if seps and ")" in seps[0] and 2 <= sizes[0] <= 5 or len(seps) > 1 and ")" in seps[1] else "odd bracket")
        if sum(s.count("(") + s.count("[") for s in [lead, *seps]) != sum(s.count(")") + s.count("]") for s in seps):
            f.append("open bracket")
        if 13 <= d <= 19:
            f.append(("check digit" if luhn(whole) else "no check digit") + (" grouped" if len(sizes) > 1 and max(sizes) <= 6 and min(sizes) >= 3 else ""))
        if len(groups) == 4 and max(sizes) <= 3:
            dots = all(s.strip(" ()[]") == "." for s in seps)
            f.append(("quad" if all(int(g) <= 255 for g in groups) else "large quad") + (" dots" if dots else " other"))
            if dots and any(s.endswith(" ") and not s.startswith(" ") for s in seps):
                f.append("list of numbers")
        if len(groups) in (3, 5, 6) and (sizes[:3] in ([4, 2, 2], [2, 2, 4], [1, 2, 4], [2, 1, 4], [4, 1, 2], [4, 2, 1])):
            f.append("date")
        if all(len(g) == 4 and g[:2] in ("18", "19", "20") for g in groups):
            f.append("years")
        if len(groups) > 2 and all(len(g) == 3 for g in groups[1:]) and len(groups[0]) <= 3 and len(set(seps)) == 1:
            f.append("thousands")
        if lead.startswith("+") or whole.startswith("00"):
            f.append("country code")
        return f

    def mails(text, toks):
        for i, (t, lo, _) in enumerate(toks):
            if not (t[0].isalnum()) or i and toks[i - 1][2] == lo and toks[i - 1][0] in ".-_+%":
                continue
            at, dots, words, j, tight = None, [], 0, i, False
            local = []
            last = min(len(toks), i + MOST_TOKENS)
            while j < last:
                u, a, b = toks[j]
                gap = text[toks[j - 1][2]:a] if j > i else ""
                if len(gap) > 1 or "\n" in gap or gap and tight:
                    break
                mark, tight = None, False
                if u in near and j + 2 < last and toks[j + 2][0] == near[u] and (toks[j + 1][0] == "@" or toks[j + 1][0] == "." or toks[j + 1][0].lower() in ("at", "dot")):
                    mark, inner, wide = "bracket", toks[j + 1][0].lower(), 3
                elif u == "@" or u == ".":
                    mark, inner, wide = ("spaced" if gap else "char"), u, 1
                elif u.lower() in ("at", "dot") and gap and j + 1 < last and text[b:toks[j + 1][1]]:
                    mark, inner, wide = "word", u.lower(), 1
                if mark:
                    if not words:
                        break
                    if inner in ("@", "at"):
                        if at is not None:
                            break
                        at = mark + " " + inner
                    else:
                        dots.append((at is not None, mark + " " + inner))
                    j, words, tight = j + wide, 0, mark == "char"
                    continue
                if not (u[0].isalnum() or u in "-_+%"):
                    break
                if words and gap:               # two words side by side are not one name
                    break
                if at is None:
                    local.append(u)
                words += 1
                if at is not None and u[0].isascii() and u[0].isalpha() and any(d for d, _ in dots):
                    yield i, j + 1, _mail_features(at, dots, local, u, text[b:b + 1]) + around(text, toks, i, j + 1)
                j += 1

    def _mail_features(at, dots, local, tail, behind):
        kinds = sorted({k for d, k in dots if d})
        f = ["mail", f"at {at}", "dots " + " ".join(kinds), f"at {at} dots {' '.join(kinds)}", f"labels {min(4, sum(d for d, _ in dots))}",
             f"tail {min(len(tail), 7)}", "tail lower" if tail.islower() else "tail other"]
        f.append("local plain" if len(local) == 1 and local[0].isalpha() and not any(not d for d, _ in dots) else "local made")
        f.append(f"{f[-1]} at {at} dots {' '.join(kinds)}")
        if behind and (behind.isalnum() or behind in "-_@"):
            f.append("cut tail")
        return f

    def segments(text, toks):
        out = [(i, j, (1, 2, 3), f) for i, j, f in numbers(text, toks)]
        return out + [(i, j, (0,), f) for i, j, f in mails(text, toks)]

    return windows, tokens, segments


def _examples(seed: int, each: int, words: list[str]) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Generated windows: (text, [(start, end, kind)]), spellings and near misses alike."""
    import random
    rng = random.Random(seed)

    def digits(n, first="0123456789"):
        return rng.choice(first) + "".join(rng.choice("0123456789") for _ in range(n - 1))

    def number(n, right=True):
        while True:
            d = digits(n, "3456")
            if luhn(d) == right:
                return d

    def split(d, sizes, sep):
        out, at = [], 0
        for n in sizes:
            out.append(d[at:at + n])
            at += n
        return sep.join(out)

    def name(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))

    def email():
        who = rng.choice([name(rng.randint(3, 9)), f"{name(4)}.{name(6)}", f"{name(5)}{digits(2)}", f"{name(3)}_{name(5)}"])
        host = [name(rng.randint(3, 9)) for _ in range(rng.choice([1, 1, 2]))] + [rng.choice(["com", "org", "de", "net", "co", "info", "edu"])]
        at, dot = rng.choice([("@", "."), (" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", "."), ("(at)", "."), (" @ ", "."), (" {at} ", " {dot} "),
                              ("@", " dot "), ("[@]", "."), (" AT ", " DOT "), ("@", "[.]"), ("(at)", "(dot)"), (" [at] ", " [dot] ")])
        return (who if dot == "." else who.replace(".", dot if rng.random() < .5 else ".")) + at + dot.join(host)

    def ip():
        return rng.choice([".", "[.]", "[.]", " . ", "(.)", ". "[:1]]).join(str(rng.choice([rng.randint(0, 255), rng.randint(1, 99)])) for _ in range(4))

    def card():
        if rng.random() < .25:
            d = rng.choice(["34", "37"]) + digits(13)
            d = next(x for x in (d[:-1] + c for c in "0123456789") if luhn(x))
            return split(d, (4, 6, 5), rng.choice([" ", "-", ".", "/"]))
        return split(number(16), (4, 4, 4, 4), rng.choice([" ", "-", ".", "", " - ", "/", ". "[:1], "  "]))

    def phone():
        a, b, c = digits(3, "23456789"), digits(3), digits(4)
        return rng.choice([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"({a}){b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}", f"+{digits(2, '3456')} {a} {digits(7)}",
                           f"00{digits(2, '3456')} {a} {digits(7)}", f"0{a}/{digits(7)}", f"0{a}-{digits(7)}", f"(0{a}) {digits(7)}", f"+{digits(2, '3456')}/{a}/{digits(7)}",
                           f"+{digits(2, '3456')}{digits(10)}", f"({a}) {b} {c}", f"0{digits(2, '1234')}/{digits(3)} {digits(4)}", f"+1 [{a}] {b}-{c}"])

    def spoken():
        return rng.choice(["tel", "phone", "call", "fon", "mobile", "dial"]) + rng.choice([" ", ": ", ". "]), \
            rng.choice([f"{digits(3, '23456789')} {digits(3)} {digits(4)}", f"{digits(3)}-{digits(4)}", f"0{digits(3)} {digits(6)}", digits(10), f"0{digits(2)} {digits(4)} {digits(4)}"])

    def miss():
        y, mo, da = rng.randint(1900, 2030), rng.randint(10, 12), rng.randint(10, 28)
        q = [rng.randint(0, 255) for _ in range(4)]
        big = [*q]
        big[rng.randrange(4)] = rng.randint(256, 999)
        return rng.choice([
            f"{y}-{mo}-{da}", f"{da}.{mo}.{y}", f"{da}/{mo}/{y}", f"{y}/{mo}/{da}", f"{y}-{y + 5}", f"{y}{mo}{da}", f"{y}-{mo}-{da} {da}:{mo}:{da}", f"{y} {y + 1} {y + 2}",
            split(number(16, False), (4, 4, 4, 4), rng.choice([" ", "-", ".", ""])), split(number(16, False), (4, 4, 4, 4), " "), number(16, False), digits(rng.randint(7, 19)), digits(8),
            digits(14), digits(13), split(digits(15), (4, 6, 5), " ") + "0", ".".join(map(str, big)), "[.]".join(map(str, big)), " ".join(map(str, q)), ", ".join(map(str, q)), ". ".join(map(str, q)),
            f"{rng.randint(1, 20)}.{rng.randint(0, 40)}.{rng.randint(0, 9)}", f"{rng.randint(1, 9)},{digits(3)},{digits(3)}", f"{rng.randint(1, 9)} {digits(3)} {digits(3)}",
            f"978-{digits(1)}-{digits(2)}-{digits(6)}-{digits(1)}", f"{digits(5)}-{digits(4)}", f"{digits(2)}.{digits(6)}", f"{digits(2)}.{digits(6)}, {digits(2)}.{digits(6)}",
            f"{digits(3)} {digits(3)} {digits(4)}", f"{digits(4)} {digits(4)} {digits(4)}", f"order {digits(4)}-{digits(6)}", f"ref {digits(3)}-{digits(5)}", f"({y}) {digits(3)}-{digits(3)}",
            f"{rng.choice(words)} at {name(6)}.com", f"look at {name(5)}.org", f"@{name(7)}", f"at the dot {name(4)}", f"{name(4)} at {name(5)}. {name(4).title()}", f"{name(4)} @ {name(5)}",
            f"{digits(10)}", f"{digits(4)}/{digits(4)}", f"${digits(4)}.{digits(2)}", f"{digits(3)}-{digits(2)}", f"{name(2)}{digits(8)}", f"{digits(7)}{name(1)}{digits(6)}", f"v{digits(1)}.{digits(2)}.{digits(4)}"])

    out = []
    for n in range(each):
        for kind, make in ((0, email), (1, ip), (2, card), (3, phone), (3, None), (None, miss), (None, miss), (None, miss), (None, miss)):
            cue, value = ("", make()) if make else spoken()
            left = " ".join(rng.choice(words) for _ in range(rng.randint(0, 3)))
            right = " ".join(rng.choice(words) for _ in range(rng.randint(0, 3)))
            text = left + (rng.choice([" ", " ", " ", ": ", ", ", "\n", ' "', " ("]) if left else "") + cue
            lo = len(text)
            text += value + rng.choice([" ", " ", ". ", ", ", "\n", '" ', "### ", ") "]) + right
            out.append((text, [] if kind is None else [(lo, lo + len(value), kind)]))
    return out


def fit_field(windows: list[tuple[str, list[tuple[int, int, int]]]], steps: int = 200, rate: float = 0.15, penalty: float = 0.02) -> dict:
    """Weights {feature: one per kind} and transitions that maximise the penalised conditional
    likelihood of the gold spans ``(start, end, kind)`` of each window."""
    import numpy as np
    _, tokens, segments = span_reader()
    vocab: dict[tuple[int, str], int] = {}
    rows, sizes, gold = [], [], []
    for text, spans in windows:
        toks = tokens(text, 0, len(text))
        w, mine = len(sizes), {s: None for s in spans}
        found = []
        for i, j, kinds, f in segments(text, toks):
            for kind in kinds:
                right = (toks[i][1], toks[j - 1][2], kind) in mine
                found.append((w, i, j, kind, [vocab.setdefault((kind, x), len(vocab)) for x in f], right))
        if sum(r[5] for r in found) != len(spans):
            continue                            # a span the reader does not propose teaches nothing
        rows += found
        sizes.append(len(toks))
    if not rows:
        return {"weights": {}, "moves": [[0.0] * 5 for _ in range(5)]}
    w, i, j, kind = (np.array([r[k] for r in rows]) for k in range(4))
    right = np.array([r[5] for r in rows])
    width = max(len(r[4]) for r in rows)
    feats = np.full((len(rows), width), len(vocab))
    for k, r in enumerate(rows):
        feats[k, :len(r[4])] = r[4]
    n, most, sizes = len(sizes), max(sizes), np.array(sizes)
    label = kind + 1                            # 0 is outside
    ends = [np.flatnonzero(j == t) for t in range(most + 1)]
    starts = [np.flatnonzero(i == t) for t in range(most + 1)]
    # gold path: label before each gold segment, and after it
    gold_moves = np.zeros((5, 5))
    by_window: dict[int, list[int]] = {}
    for k in np.flatnonzero(right):
        by_window.setdefault(int(w[k]), []).append(int(k))
    for x in range(n):
        at, was = 0, 0
        for k in sorted(by_window.get(x, []), key=lambda k: i[k]):
            for _ in range(i[k] - at):
                gold_moves[was, 0] += 1
                was = 0
            gold_moves[was, label[k]] += 1
            was, at = int(label[k]), int(j[k])
        for _ in range(sizes[x] - at):
            gold_moves[was, 0] += 1
            was = 0
    gold_counts = np.bincount(feats[right].ravel(), minlength=len(vocab) + 1).astype(float)
    theta, moves = np.zeros(len(vocab) + 1), np.zeros((5, 5))
    m = [np.zeros_like(theta), np.zeros_like(moves)]
    v = [np.zeros_like(theta), np.zeros_like(moves)]

    def lse(x, axis):
        top = x.max(axis=axis, keepdims=True)
        top = np.where(np.isfinite(top), top, 0)
        with np.errstate(divide="ignore"):
            return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)

    for step in range(1, steps + 1):
        theta[-1] = 0
        score = theta[feats].sum(axis=1)
        alpha = np.full((most + 1, n, 5), -np.inf)
        alpha[0, :, 0] = 0
        for t in range(1, most + 1):
            alpha[t, :, 0] = lse(alpha[t - 1] + moves[:, 0], 1)
            k = ends[t]
            if len(k):
                add = lse(alpha[i[k], w[k]] + moves[:, label[k]].T, 1) + score[k]
                np.logaddexp.at(alpha[t], (w[k], label[k]), add)
        beta = np.full((most + 1, n, 5), -np.inf)
        beta[sizes, np.arange(n), :] = 0
        for t in range(most - 1, -1, -1):
            open_ = t < sizes
            out = np.where(open_[:, None], beta[t + 1][:, :1] + moves[:, 0][None, :], -np.inf)
            k = starts[t]
            if len(k):
                np.logaddexp.at(out, (w[k],), (beta[j[k], w[k], label[k]] + score[k])[:, None] + moves[:, label[k]].T)
            beta[t] = np.where(open_[:, None], out, beta[t])
        total = lse(alpha[sizes, np.arange(n)], 1)
        pair = np.exp(alpha[i, w] + moves[:, label].T + (score + beta[j, w, label] - total[w])[:, None])
        expected = np.bincount(feats.ravel(), weights=np.repeat(pair.sum(axis=1), width), minlength=len(vocab) + 1)
        grad_moves = gold_moves.copy()
        for y in range(1, 5):
            grad_moves[:, y] -= pair[label == y].sum(axis=0)
        for t in range(most):
            here = np.flatnonzero(t < sizes)
            grad_moves[:, 0] -= np.exp(alpha[t, here] + moves[:, 0] + beta[t + 1, here, :1] - total[here, None]).sum(axis=0)
        for at, (x, g) in enumerate(((theta, gold_counts - expected - penalty * theta), (moves, grad_moves - penalty * moves))):
            m[at] = 0.9 * m[at] + 0.1 * g
            v[at] = 0.99 * v[at] + 0.01 * g * g
            x += rate * (m[at] / (1 - 0.9 ** step)) / (np.sqrt(v[at] / (1 - 0.99 ** step)) + 1e-8)
    weights: dict[str, list[float]] = {}
    for (kind, f), k in vocab.items():
        weights.setdefault(f, [0.0] * 4)[kind] = float(theta[k])
    return {"weights": weights, "moves": moves.tolist()}


def span_finder(model: dict):
    """A function text -> [(kind, start, end, added)] by kind as listed, then start."""
    from bisect import bisect_right
    base, (windows, tokens, segments) = base_finder(), span_reader()
    weights, moves = model["weights"], model["moves"]

    def decode(text, lo, hi):
        """Best segmentation of a window: its segments (start, end, kind)."""
        toks = tokens(text, lo, hi)
        ending: dict[int, list] = {}
        for i, j, kinds, f in segments(text, toks):
            rows = [w for x in f if (w := weights.get(x))]
            for kind in kinds:
                ending.setdefault(j, []).append((i, kind + 1, sum([w[kind] for w in rows])))
        if not ending:
            return []
        best, back = [[0.0, None, None, None, None]], [[None] * 5]
        for t in range(1, len(toks) + 1):
            now, via = [None] * 5, [None] * 5
            was = best[t - 1]
            y = max((y for y in range(5) if was[y] is not None), key=lambda y: was[y] + moves[y][0])
            now[0], via[0] = was[y] + moves[y][0], (t - 1, y)
            for i, label, s in ending.get(t, ()):
                was = best[i]
                y = max((y for y in range(5) if was[y] is not None), key=lambda y: was[y] + moves[y][label])
                total = was[y] + moves[y][label] + s
                if now[label] is None or total > now[label]:
                    now[label], via[label] = total, (i, y)
            best.append(now)
            back.append(via)
        out, t = [], len(toks)
        y = max((y for y in range(5) if best[t][y] is not None), key=lambda y: best[t][y])
        while t:
            i, before = back[t][y]
            if y:
                out.append((toks[i][1], toks[t - 1][2], y - 1))
            t, y = i, before
        return out[::-1]

    def find(text):
        if not text:
            return []
        fixed = base(text)
        out = [(k, lo, hi, False) for k in KINDS for lo, hi in fixed[k]]
        taken = []                      # the union of the base spans, in order and apart
        for lo, hi in sorted(s for spans in fixed.values() for s in spans):
            if taken and lo <= taken[-1][1]:
                taken[-1] = (taken[-1][0], max(hi, taken[-1][1]))
            else:
                taken.append((lo, hi))
        ends = [hi for _, hi in taken]
        for lo, hi in windows(text, taken):
            for start, end, kind in decode(text, lo, hi):
                k = bisect_right(ends, start)
                if k == len(taken) or taken[k][0] >= end:
                    out.append((KINDS[kind], start, end, True))
        return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))

    return find


def train(docs: DataFrame, sample_rows: int = 4000, text_col: str = "text", each: int = 60) -> dict:
    """The field's weights: generated spellings among the corpus's words, and base matches (failed
    ones as near misses) of a bounded sample of rows."""
    total = docs.count()
    text = F.col(text_col).cast("string")
    share = min(1.0, sample_rows / max(1, total))
    picked = docs.select(text.alias("text")).filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)

    def contexts(batches):
        import pyarrow as pa
        find, (windows, _, _) = base_finder(), span_reader()
        for b in batches:
            out = {"text": [], "spans": [], "words": []}
            for t in b.column(0).to_pylist():
                if not t:
                    continue
                fixed = [(lo, hi, k) for k, name in enumerate(KINDS) for lo, hi in find(t)[name]]
                for lo, hi in windows(t)[:4]:
                    inside = [(a - lo, e - lo, k) for a, e, k in fixed if a < hi and lo < e]
                    if inside and hi - lo < 400 and all(a >= 0 and e <= hi - lo for a, e, _ in inside):
                        out["text"].append(t[lo:hi])
                        out["spans"].append([x for s in inside for x in s])
                        out["words"].append([w for w in t[:400].split()[1:9] if w.isalpha()])
            yield pa.RecordBatch.from_arrays([pa.array(out["text"], pa.string()), pa.array(out["spans"], pa.list_(pa.int64())),
                                              pa.array(out["words"], pa.list_(pa.string()))], names=["text", "spans", "words"])

    rows = (picked.limit(2 * sample_rows).mapInArrow(contexts, "text string, spans array<long>, words array<string>")
            .orderBy(F.xxhash64("text"), "text").limit(300).collect())
    words = sorted({w for r in rows for w in r["words"]})[:2000] or ["the", "and", "with", "from", "near", "about", "office", "please"]
    real = []
    for r in rows:
        s = r["spans"]
        spans = sorted(zip(s[0::3], s[1::3], s[2::3]))
        if all(a[1] <= b[0] for a, b in zip(spans, spans[1:])):
            real.append((r["text"], spans))
    return fit_field([*_examples(1, each, words), *real])


FOUND = "array<struct<kind:string,start:bigint,end:bigint,added:boolean>>"


def with_spans(docs: DataFrame, model: dict, text_col: str = "text", found_col: str = "_llm_personal") -> DataFrame:
    """``docs`` with the array of spans; all columns pass through."""
    from recordlink.llm.common import arrow_schema
    schema = docs.select("*", F.lit(None).cast(FOUND).alias(found_col)).schema
    at = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa
        find, target = span_finder(model), arrow_schema(schema)
        kind = target.field(len(target) - 1).type
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                piece = b.slice(lo, 1024)
                rows = [[dict(zip(("kind", "start", "end", "added"), s)) for s in find(t)] for t in piece.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(rows, kind)], names=target.names)

    return docs.mapInArrow(run, schema)


def personal_report(docs: DataFrame, model: dict | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: numbers of base spans, the digest of the base spans, all spans, and how many the
    field added."""
    model = train(docs, text_col=text_col) if model is None else model
    found = with_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), model)
    base = F.filter("_llm_personal", lambda s: ~s["added"])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[number(k) for k in KINDS],
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("_llm_personal")).alias("spans"),
                        F.size(F.filter("_llm_personal", lambda s: s["added"])).cast("long").alias("n_added"))


def redact_personal(docs: DataFrame, model: dict | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets (overlapping spans once); a null
    text stays null. Same columns."""
    model = train(docs, text_col=text_col) if model is None else model
    schema, at = docs.schema, docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa
        find = span_finder(model)

        def clean(text):
            out, done = [], 0
            for kind, lo, hi, _ in sorted(find(text), key=lambda s: (s[1], -s[2])):
                if lo >= done:
                    out += [text[done:lo], f"[{kind}]"]
                done = max(done, hi)
            return "".join([*out, text[done:]]) if out else text

        for b in batches:
            cols = list(b.columns)
            cols[at] = pa.array([clean(t) for t in cols[at].to_pylist()], b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    return docs.mapInArrow(run, schema)
