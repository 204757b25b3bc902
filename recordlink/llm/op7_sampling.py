"""SentencePiece encoding and decoding: sampled segmentations by Gumbel top-k without
replacement.

A text's lattice has every piece of the model that matches at every position. A segmentation
weighs the sum of its pieces' log weights: the model's own scores when they are log
probabilities, or, for merge-ranked (BPE) models, Zipf's law over the rank. No piece spans a word
start (the mark that stands for a blank) or a newline, so the lattice is a chain of word
lattices; a distinct word's lattice is built once and kept for the batches that follow, with backward sums that make every
node a normalised choice among its edges.

The search is perturbed A-star from the top down. The root holds the largest Gumbel-perturbed
log probability of all segmentations. Following the path of the maximum, every node leaves
behind the group of its other edges, whose largest perturbed value is a Gumbel truncated at the
path's. The best group seen so far is split next: one of its edges takes the value, the rest
stays a group, and the path is continued to the end. Paths come out in falling order, are
distinct, and are a sample without replacement; the ``k + 1``-th value is the threshold that
gives each its inclusion probability ``1 - exp(-exp(log p - threshold))`` (kept as a logarithm).

All random numbers are hashes of (seed, row key, draw, position), so a row gets the same samples
in any partition and on any retry.

Edge cases: a null or empty text has one sample, the empty one, of log inclusion 0; texts with fewer
than ``k`` segmentations return all of them; a null key counts as key 0 for the seed and is
returned as null; repeated rows repeat their samples; an empty table returns no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlink.llm.common import worker_held
from recordlink.llm.encoding import vocabulary_path

SAMPLES = "doc_id long, sample int, n_pieces long, ids_crc32 long, log_prob double, log_inclusion double, ids array<int>"
DECODED = SAMPLES.replace("ids array<int>", "text_crc32 long, round_trip boolean")


def make_decoder(model: str):
    """Functions ids (list or array) -> text; text -> its normalised text, blanks as marks; that -> the text its ids decode to."""
    import numpy as np
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    lead = sp.normalize("a").startswith("▁")       # the model puts a blank before every text
    # What a piece stands for: UTF-8 or a byte; for others (control pieces and the like) the library decides.
    size = sp.get_piece_size()
    byte = np.array([sp.is_byte(i) for i in range(size)])
    other = np.array([sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(size)])
    shows = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if byte[i] else sp.id_to_piece(i).replace("▁", " ").encode() for i in range(size)]
    flat, width = np.frombuffer(b"".join(shows), np.uint8), np.array([len(x) for x in shows])
    first = np.cumsum(width) - width
    loses = np.array([lead and x[:1] == b" " for x in shows]) & ~byte      # a blank, as the first piece

    def joined(ids):
        """The text of an array of ids, None if the library has to decode them."""
        if ids.dtype.kind != "i" or ids.min() < 0 or ids.max() >= size or other[ids].any():
            return None
        n = width[ids]
        after = np.cumsum(n)
        at = np.repeat(first[ids] - (after - n), n)
        at += np.arange(len(at))
        try:
            return flat[at].tobytes()[int(loses[ids[0]]):].decode()
        except UnicodeDecodeError:                  # bytes that make no character
            return None

    some = np.flatnonzero(~other & ~(byte & (np.array([x[:1] > b"\x7f" for x in shows]))))
    as_library = "▁▁" in sp.normalize("a  a") and all(
        joined(x) == sp.decode(x.tolist()) for x in (some, some[::-1], *(some[i:i + 3] for i in range(0, len(some), 97)),
                                                     *(np.append(i, some[:2]) for i in np.flatnonzero(loses)[:9])))

    def back(ids):
        if ids is None or not len(ids):
            return None if ids is None else ""
        text = joined(np.asarray(ids)) if as_library else None
        return sp.decode(np.asarray(ids).tolist()) if text is None else text

    def normal(text):
        return sp.normalize(text) if text else ""

    def shown(marked):
        return marked.replace("▁", " ")[lead:]

    return back, normal, shown


def _buckets(table):
    """For sorted 64-bit hashes: a shift, the first place per value of the bits above it (the
    place 0 for none), and the most hashes that share those bits."""
    import numpy as np
    bits = max(4, int(len(table)).bit_length() + 2)
    top = (table >> np.uint64(64 - bits)).astype(np.int64)
    head = np.zeros(1 << bits, np.int64)
    head[top[::-1]] = np.arange(len(table))[::-1]
    return np.uint64(64 - bits), head, int(np.bincount(top).max())


def make_sampler(model: str, k: int, seed: int, temperature: float = 1.0, lattice_points: int = 3_000_000):
    """A function (texts, keys) -> per text a list of (ids, log probability, log inclusion);
    ``normalised`` says that ``make_decoder`` has normalised them. It keeps the lattices of the words that it met, up to
    ``lattice_points`` code points (about 100 bytes each); then, and for larger calls, it starts anew."""
    import heapq
    import itertools
    import math
    import re

    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    size = sp.get_piece_size()
    plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    byte_id = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(size) if sp.is_byte(i)}
    if len(byte_id) != 256:
        raise ValueError("the model needs byte pieces for characters outside its vocabulary")
    pieces, scores = [sp.id_to_piece(i) for i in plain], np.array([sp.get_score(i) for i in plain])
    if any(re.search("[^▁]▁|.\n|\n.", p) for p in pieces):
        raise ValueError("a piece spans a word start or a newline")
    ranked = np.array_equal(scores, np.round(scores))
    weight = -np.log(3.0 - scores) if ranked else scores.astype(float)
    weight = (weight - math.log(np.exp(weight).sum())) * temperature
    rare = float(weight.min())
    odd = np.uint64(0x9E3779B97F4A7C15)
    # Per length in code points: sorted 64-bit polynomial hashes of all piece prefixes of that
    # length, with the piece's id and weight where the prefix is a whole piece (else -1).
    width = np.array([len(p) for p in pieces])
    codes = np.zeros((len(pieces), int(width.max())), np.uint64)
    for i, p in enumerate(pieces):
        codes[i, :len(p)] = [ord(c) for c in p]
    by_length, h = {}, np.zeros(len(pieces), np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, codes.shape[1] + 1):
            h = (h ^ codes[:, n - 1]) * odd
            h ^= h >> np.uint64(29)
            table = np.unique(h[width >= n])
            ids, cost = np.full(len(table), -1), np.zeros(len(table))
            whole = width == n
            ids[np.searchsorted(table, h[whole])], cost[np.searchsorted(table, h[whole])] = np.array(plain)[whole], weight[whole]
            by_length[n] = (table, ids, cost, *_buckets(table))
    longest = max(by_length)
    known, held, used = {}, None, [0] * 7           # words and their lattices, with room for more
    mix1, mix2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

    def stream(key, draw: int):
        """Where the numbers of (seed, key, draw) begin."""
        return (key + np.uint64((seed * 1_000_003 + draw * 7919 + 1) & (2 ** 64 - 1))) * odd

    def uniform(h):
        """Numbers in (0, 1) from hashes of ``stream`` + position; ``h`` is overwritten."""
        h ^= h >> np.uint64(30)
        h *= mix1
        h ^= h >> np.uint64(27)
        h *= mix2
        h ^= h >> np.uint64(31)
        h >>= np.uint64(11)
        u = h.astype(np.float64)
        u += 0.5
        u *= 2.0 ** -53
        return u

    def one(key: int, draw: int, at: int = 0) -> float:
        """The number that ``uniform`` makes of ``stream(key, draw) + at``, in plain integers."""
        h = ((key + seed * 1_000_003 + draw * 7919 + 1) * int(odd) + at) & (2 ** 64 - 1)
        h = (h ^ h >> 30) * int(mix1) & (2 ** 64 - 1)
        h = (h ^ h >> 27) * int(mix2) & (2 ** 64 - 1)
        return (float((h ^ h >> 31) >> 11) + 0.5) * 2.0 ** -53

    def find(length: int, g):
        """Places of the hashes that are prefixes of this length, and the places among ``g`` that are."""
        table, _, _, shift, head, deepest = by_length[length]
        at = head[g >> shift]
        known = table[at] == g
        for _ in range(deepest - 1):                # further entries of the same bucket
            rest = np.flatnonzero(~known)
            at[rest] += 1
            known[rest] = table[np.minimum(at[rest], len(table) - 1)] == g[rest]
        return at[known], known

    def lattices(words: list[str]):
        """Edges of all words' lattices: (root per word, first edge and end per node, per edge
        next node, piece id, probability, cumulative probability). Nodes are code points."""
        text = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        n = np.array([len(w) for w in words])
        stop = np.repeat(np.cumsum(n), n)
        pos = np.arange(len(text))
        start, end, piece, cost = [], [], [], []
        h, at = np.zeros(len(text), np.uint64), pos
        single = np.zeros(len(text), bool)
        for length in range(1, longest + 1):
            at = at[at + length <= stop[at]]
            if not len(at):
                break
            g = (h[at] ^ text[at + length - 1]) * odd
            g ^= g >> np.uint64(29)
            h[at] = g
            ids, costs = by_length[length][1:3]
            place, known = find(length, g)          # where not known no piece goes on
            at = at[known]
            hit = ids[place] >= 0
            s = at[hit]
            start.append(s)
            end.append(s + length)
            piece.append(ids[place[hit]])
            cost.append(costs[place[hit]])
            if length == 1:
                single[s] = True
        odd_ones = pos[~single]                     # outside the vocabulary: spelt in bytes, -1 - code point
        cp = text[odd_ones].astype(np.int64)
        n_bytes = 1 + (cp > 0x7F) + (cp > 0x7FF) + (cp > 0xFFFF)
        start.append(odd_ones)
        end.append(odd_ones + 1)
        ascii_id = np.array([byte_id[i] for i in range(128)])
        piece.append(np.where(cp < 128, ascii_id[np.minimum(cp, 127)], -1 - cp))
        cost.append((rare - 1.0) * n_bytes)
        start, end, piece, cost = (np.concatenate(x) for x in (start, end, piece, cost))
        # Long pieces first within a node; nodes by distance from their word's end, for the backward sums.
        order = np.lexsort((start - end, start))
        start, end, piece, cost = start[order], end[order], piece[order], cost[order]
        first = np.searchsorted(start, pos)
        last = np.searchsorted(start, pos, "right")
        beta = np.zeros(len(text) + 1)
        left = stop - pos
        nodes = np.argsort(left, kind="stable")
        cuts = np.searchsorted(left[nodes], np.arange(1, int(left.max()) + 2)) if len(nodes) else [0]
        final = stop[start] == end
        for a, b in zip(cuts, cuts[1:]):
            some = nodes[a:b]
            width = last[some] - first[some]
            edge = np.repeat(first[some] - (np.cumsum(width) - width), width) + np.arange(width.sum())
            v = cost[edge] + np.where(final[edge], 0.0, beta[end[edge]])
            heads = np.cumsum(width) - width
            top = np.maximum.reduceat(v, heads)
            beta[some] = top + np.log(np.add.reduceat(np.exp(v - np.repeat(top, width)), heads))
        prob = np.exp(cost + np.where(final, 0.0, beta[end]) - beta[start])
        total = np.cumsum(prob)
        cum = total - np.repeat((total - prob)[first], last - first)
        cum[last - 1] = 2.0                         # the last edge takes what rounding leaves
        return np.cumsum(n) - n, first, last, np.where(final, -1, end), piece, prob, cum

    def descend(lat, nodes, keys, draw, order):
        """Sample from each start node to its word's end: edges in order, and their word's place."""
        _, first, _, nxt, _, _, cum = lat
        who, step, got_who, got_step, got_edge = np.arange(len(nodes)), 0, [], [], []
        at = stream(keys, draw) + order.astype(np.uint64) * np.uint64(65_536)
        while len(who):
            u = uniform(at + np.uint64(step))
            e = first[nodes]
            todo = np.flatnonzero(u > cum[e])
            while len(todo):
                e[todo] += 1
                todo = todo[u[todo] > cum[e[todo]]]
            got_who.append(who)
            got_step.append(np.full(len(who), step))
            got_edge.append(e)
            nodes = nxt[e]
            more = nodes >= 0
            who, nodes, at, step = who[more], nodes[more], at[more], step + 1
        who, step, edge = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (got_who, got_step, got_edge))
        n = np.bincount(who, minlength=0) if len(who) else np.zeros(0, np.int64)
        place = (np.cumsum(n) - n)[who] + step if len(who) else who
        out_edge, out_who = np.empty(len(edge), np.int64), np.empty(len(edge), np.int64)
        out_edge[place], out_who[place] = edge, who
        return out_edge, out_who

    def spell(ids):
        if (ids >= 0).all():
            return ids
        out: list[int] = []
        for i in ids.tolist():
            out += [i] if i >= 0 else [byte_id[b] for b in chr(-1 - i).encode("utf-8", "surrogatepass")]
        return np.array(out, np.int64)

    def cut(texts):
        """The distinct words of normalised texts (marks with what follows them, and newlines), the place
        among them of every word, and the number of words per text."""
        sep = next(c for c in map(chr, itertools.chain(range(10), range(0xE000, 0xF900))) if not any(c in t for t in texts))
        marked = pa.array(texts, pa.large_string())
        if any("▁▁" in t for t in texts):
            marked = pc.replace_substring_regex(marked, "(▁+)", sep + "\\1")
        else:
            marked = pc.replace_substring(marked, "▁", sep + "▁")
        split = pc.split_pattern(pc.replace_substring(marked, "\n", f"{sep}\n{sep}"), sep)
        ends = split.offsets.to_numpy()
        words = split.values.slice(ends[0], ends[-1] - ends[0])
        full = pc.greater(pc.binary_length(words), 0)
        before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])[ends - ends[0]]
        coded = words.filter(full).dictionary_encode()
        return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(), np.diff(before)

    def look_up(distinct):
        """Numbers of distinct words in the lattices kept; those of new words are added."""
        nonlocal known, held, used
        numbers = np.fromiter(map(known.get, distinct, itertools.repeat(-1)), np.int64, len(distinct))
        fresh = np.flatnonzero(numbers < 0)
        new = [distinct[i] for i in fresh.tolist()]
        if held is not None and used[1] + sum(map(len, new)) > lattice_points:
            known, used, new, fresh = {}, [0] * 7, distinct, np.arange(len(distinct))
            if len(held[1]) > 2 * lattice_points:   # room that a large call took
                held = None
        if new:
            root, first, last, follow, *rest = lattices(new)
            nodes, edges = used[1], used[3]
            more = (root + nodes, first + edges, last + edges, np.where(follow < 0, -1, follow + nodes), *rest)
            held = held or [x[:0] for x in more]
            for i, x in enumerate(more):
                if used[i] + len(x) > len(held[i]):     # room for half as much again
                    room = np.empty((used[i] + len(x)) * 3 // 2, x.dtype)
                    room[:used[i]] = held[i][:used[i]]
                    held[i] = room
                held[i][used[i]:used[i] + len(x)] = x
                used[i] += len(x)
            numbers[fresh] = np.arange(len(known), len(known) + len(new))
            known.update(zip(new, numbers[fresh].tolist()))
        return numbers, held and tuple(x[:n] for x, n in zip(held, used))

    def sample(texts, keys, normalised=False):
        if not normalised:
            texts = [sp.normalize(t) if t else "" for t in texts]
        distinct, places, sizes = cut(texts)
        numbers, lat = look_up(distinct)
        flat = numbers[places]
        after = np.cumsum(sizes)
        before_of = after - sizes
        empty = [(np.zeros(0, np.int64), 0.0, 0.0)]
        if not len(flat):
            return [list(empty) for _ in texts]
        all_keys = [(x or 0) & (2 ** 64 - 1) for x in keys]
        key_of = np.array(all_keys, np.uint64)
        roots, in_text = lat[0][flat], np.arange(len(flat)) - np.repeat(before_of, sizes)
        # All texts of the block are searched in step: each round pops every text's best group,
        # and the new paths of all texts go down together.
        done, heaps = [[] for _ in texts], [[] for _ in texts]
        threshold = [-math.inf] * len(texts)

        def add(some, paths, values, skips):
            """Paths of the texts ``some``: (edges, their words' places, their logs); and the largest
            perturbed values of the groups left behind along each, from its step in ``skips``."""
            number, counts = len(done[some[0]]), []
            for t, (edges, place, logs), value, skip in zip(some, paths, values, skips):
                done[t].append((edges, place, np.cumsum(logs) - logs, logs))
                counts.append(len(edges) - skip)
            rest = 1.0 - lat[5][np.concatenate([x[0][skip:] for x, skip in zip(paths, skips)])]
            rest[rest <= 1e-15] = 0.0               # no other edge: minus infinity below
            phi = np.concatenate([done[t][-1][2][skip:] for t, skip in zip(some, skips)]) + np.log(rest)
            ends = np.cumsum(counts)
            step = np.arange(len(phi)) + np.repeat(np.array(skips) - (ends - counts), counts)
            noise = np.log(uniform(np.repeat(stream(key_of[some], 10 * number + 2), counts) + step.astype(np.uint64)))
            v = phi - np.log(np.exp(phi - np.repeat(np.array(values), counts)) - noise)
            for t, n, end, skip in zip(some, counts, ends.tolist(), skips):
                x = v[end - n:end]
                keep = min(n, k + 1)
                for i in np.argpartition(-x, keep - 1)[:keep].tolist() if n else []:
                    if x[i] > -np.inf:
                        heapq.heappush(heaps[t], (-float(x[i]), number, skip + i, (int(done[t][-1][0][skip + i]),)))

        with np.errstate(over="ignore", divide="ignore"):
            some = np.flatnonzero(sizes).tolist()
            edges, who = descend(lat, roots, np.repeat(key_of, sizes), 0, in_text)
            cuts = np.searchsorted(who, np.concatenate([[0], after])).tolist()
            logs, place = np.log(lat[5][edges]), in_text[who]
            add(some, [tuple(x[cuts[t]:cuts[t + 1]] for x in (edges, place, logs)) for t in some],
                [-math.log(-math.log(one(all_keys[t], 1))) for t in some], [0] * len(some))
            while some:
                picked, starts, orders = [], [], []
                for t in some:
                    if not heaps[t]:
                        continue
                    value, number, at, taken = heapq.heappop(heaps[t])
                    value, key = -value, all_keys[t]
                    if len(done[t]) == k:
                        threshold[t] = value
                        continue
                    edges, place, before, _ = done[t][number]
                    node = int(np.searchsorted(lat[1], edges[at], "right") - 1)     # nodes' edge ranges are in order
                    free = [e for e in range(int(lat[1][node]), int(lat[2][node])) if e not in taken]
                    p = lat[5][free]
                    draw = 10 * len(done[t]) + 3
                    u = one(key, draw, at) * p.sum()
                    chosen = free[min(int(np.searchsorted(np.cumsum(p), u)), len(free) - 1)]
                    rest = 1.0 - float(lat[5][list(taken)].sum()) - float(lat[5][chosen])
                    if len(free) > 1 and rest > 1e-15:
                        phi = float(before[at]) + math.log(rest)
                        noise = -math.log(one(key, draw + 1, at))
                        heapq.heappush(heaps[t], (-(phi - math.log(math.exp(min(700.0, phi - value)) + noise)), number, at,
                                                  (*taken, chosen)))
                    word = int(place[at])
                    follow = int(lat[3][chosen])
                    lo, hi = int(before_of[t]) + word + 1, int(after[t])
                    if follow >= 0:
                        starts.append([follow])
                        orders.append([word])
                    starts.append(roots[lo:hi])
                    orders.append(in_text[lo:hi])
                    picked.append((t, number, at, chosen, word, value, hi - lo + (follow >= 0)))
                some = [x[0] for x in picked]
                if not some:
                    break
                counts = np.array([x[-1] for x in picked])
                begin, order = (np.concatenate(x).astype(np.int64) for x in (starts, orders))
                draw = 10 * len(done[some[0]]) + 5      # every text has as many paths by now
                tails, who = descend(lat, begin, np.repeat(key_of[some], counts), draw, order)
                cuts = np.searchsorted(who, np.concatenate([[0], np.cumsum(counts)])).tolist()
                firsts = np.log(lat[5][[x[3] for x in picked]])
                tail_logs, where = np.log(lat[5][tails]), order[who]
                paths = []
                for i, (t, number, at, chosen, word, _, _) in enumerate(picked):
                    a, b = cuts[i], cuts[i + 1]
                    edges, place, _, logs = done[t][number]
                    paths.append((np.concatenate([edges[:at], [chosen], tails[a:b]]), np.concatenate([place[:at], [word], where[a:b]]),
                                  np.concatenate([logs[:at], firsts[i:i + 1], tail_logs[a:b]])))
                add(some, paths, [x[5] for x in picked], [x[2] + 1 for x in picked])
        out = []
        for t, paths in enumerate(done):
            found = [] if paths else list(empty)
            for edges, _, before, logs in paths:
                log_p = float(before[-1] + logs[-1])
                x = log_p - threshold[t]
                log_q = x if x < -30 else 0.0 if x > 30 else math.log(-math.expm1(-math.exp(x)))
                found.append((spell(lat[4][edges]), log_p, log_q))
            out.append(found)
        return out

    return sample


def worker_sampler(model: str, k: int, seed: int, temperature: float):
    """``make_sampler``'s and ``make_decoder``'s functions, made once in a Python worker: the lattices serve the tasks that follow."""
    made, asked = worker_held("samplers"), (model, k, seed, temperature)
    if asked not in made:
        made.clear()                                # one at a time: lattices are large
        made[asked] = make_sampler(*asked), make_decoder(model)
    return made[asked]


def sample_encodings(docs: DataFrame, k: int = 2, seed: int = 0, model: str | None = None, id_col: str = "doc_id",
                     text_col: str = "text", temperature: float = 1.0, with_ids: bool = True) -> DataFrame:
    """``doc_id, sample`` (from 1, falling perturbed value), ``n_pieces, ids_crc32, log_prob,
    log_inclusion`` and ``ids``; with ``with_ids`` off, in place of the ids what they decode to:
    ``text_crc32`` of the decoded text and ``round_trip``, whether it is the normalised text."""
    model = model or vocabulary_path("piece_bpe_32k.model")
    schema = SAMPLES if with_ids else DECODED

    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa
        draw, (back, normal, shown) = worker_sampler(model, k, seed, temperature)
        names = [f.rsplit(" ", 1)[0] for f in schema.split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(),
                 *([pa.list_(pa.int32())] if with_ids else [pa.int64(), pa.bool_()])]

        def last(got, text):
            if with_ids:
                return (got.astype(np.int32),)
            decoded = back(got)
            return zlib.crc32(decoded.encode()), decoded == text

        def blocks(texts):
            """Row ranges of about a million characters, one row at least."""
            at, held = 0, 0
            for i, t in enumerate(texts):
                held += len(t or "")
                if held > 1_000_000 or i == len(texts) - 1:
                    yield at, i + 1
                    at, held = i + 1, 0

        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo, hi in blocks(texts):
                rows = []
                marked = [normal(t) for t in texts[lo:hi]]
                for doc, text, found in zip(ids[lo:hi], marked, draw(marked, ids[lo:hi], normalised=True)):
                    text = None if with_ids else shown(text)
                    for j, (got, log_p, log_q) in enumerate(found):
                        rows.append((doc, j + 1, len(got), zlib.crc32(got.astype("<u4").tobytes()), round(log_p, 6),
                                     round(log_q, 6), *last(got, text)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, schema))


def decode(encoded: DataFrame, ids_col: str = "ids", out_col: str = "text", model: str | None = None) -> DataFrame:
    """``encoded`` with the text of its piece ids; null ids give a null text. Other columns pass through."""
    from recordlink.llm.common import arrow_schema
    model = model or vocabulary_path("piece_bpe_32k.model")
    schema = encoded.select("*", F.lit(None).cast("string").alias(out_col)).schema
    at = encoded.columns.index(ids_col)

    def run(batches):
        import pyarrow as pa
        back, target = make_decoder(model)[0], arrow_schema(schema)
        for b in batches:
            texts = [back(x) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=target.names)

    return encoded.mapInArrow(run, schema)
