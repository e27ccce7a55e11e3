"""Plain versions of the operators for token alignment and conversation repair."""

import hashlib
import heapq
import re
import zlib
from collections import Counter, defaultdict


def damaged(rows):
    """rows: (conv_id, turn, role, text)"""
    tell = lambda x: " " if x is None else str(x)
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{tell(conv)}:{tell(turn)}".encode()) % 20
        role, text = tell(role), tell(text)
        out[conv]
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        visible = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not visible else "duplicate" if (role, text) in seen
                   else "truncated" if visible[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """(cost, audit, repaired) by uniform-cost search over (row, grammar state), audits compared as text."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, audit, "\n".join(lines)
        allowed = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        fill = "a" if state == "u" else "u"
        name = {"u": "user", "a": "assistant"}[fill]
        heapq.heappush(heap, (cost + 3, audit + "I", i, fill, (*lines, f"{name}:")))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, lines))
            if faults[i] in ("", "truncated"):
                more = 3 if faults[i] else 0
                if role[:1] and role[:1] in allowed:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], (*lines, f"{role}:{text}")))
                heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, fill, (*lines, f"{name}:{text}")))
    raise AssertionError("no repair")


def conversations(rows, order=None):
    """conv_id -> (gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)"""
    out = {}
    for conv, own in damaged(rows).items():
        own.sort(key=lambda r: ((r[0] is not None, r[0] or 0), *(order(r) if order else ())))
        faults = faults_of(own)
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, repaired = cheapest(own, faults)
        n = Counter(faults)
        out[conv] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit,
                     hashlib.sha256(repaired.encode()).hexdigest())
    return out


def aligned(rows, pair):
    """doc_id -> (n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) by merging the two lists of tokens."""
    found, count = {}, Counter()
    for i, text in rows:
        found[i] = ([], [], [], [])
        if not text:
            continue
        a = pair.a.encode(" " + text, add_special_tokens=False).ids
        b = pair.b.encode(text)
        given = (" " + text).encode()
        if any(b"".join(map(table.__getitem__, ids)) != given for table, ids in ((pair.a_bytes, a), (pair.b_bytes, b))):
            continue
        spans = []
        for table, ids in ((pair.a_bytes, a), (pair.b_bytes, b)):
            at, own = 0, []
            for t in ids:
                own.append((at, at := at + len(table[t])))
            spans.append(own)
        links, groups, x, y = [], [([], [])], 0, 0
        while x < len(a):
            links.append((a[x], b[y]))
            ends = spans[0][x][1], spans[1][y][1]
            if ends[0] <= ends[1]:
                groups[-1][0].append(a[x])
                x += 1
            if ends[1] <= ends[0]:
                groups[-1][1].append(b[y])
                y += 1
            if ends[0] == ends[1]:
                groups.append(([], []))
        count.update(links)
        found[i] = (a, b, groups[:-1], links)
    top = Counter()
    for (_, q), n in count.items():
        top[q] = max(top[q], n)
    text = lambda groups: ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
    return {i: (len(a), len(b), len(g), len(n), sum(count[k] == top[k[1]] for k in n), sum(count[k] for k in n),
                hashlib.sha256(text(g).encode()).hexdigest() if g else "") for i, (a, b, g, n) in found.items()}
