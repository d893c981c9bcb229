"""Plain Python versions of the conversation operators and of packing's placement."""

import hashlib
import heapq
import re
import zlib
from collections import defaultdict

ROLE_ORDER = ("", "s", "u", "a")


def by_conversation(rows, blank):
    """conv_id -> rows (turn, role, text) by turn, nulls first, then role and text."""
    held = defaultdict(list)
    for conv_id, turn, role, text in rows:
        held[conv_id].append((turn, blank if role is None else role, blank if text is None else text))
    order = lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())
    return {c: sorted(r, key=order) for c, r in held.items()}


def damaged(rows):
    """conv_id -> rows left after damage."""
    out, ids = [], {r[0] for r in rows}
    for conv_id, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        name = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv_id, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    held = by_conversation(out, " ")
    return {c: held.get(c, []) for c in ids}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\v\f\r")
        if not bare:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append(None if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, fault):
    """(cost, audit, repaired) by a search over (rows done, last initial), least cost first and then least audit."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, k, last, turns = heapq.heappop(heap)
        if (k, last) in done:
            continue
        done.add((k, last))
        if k == len(rows) and last in ("", "a"):
            return cost, audit, list(turns)
        free = [r for r in ("user", "assistant") if (last == "u") == (r == "assistant")]
        for role in free:
            heapq.heappush(heap, (cost + 3, audit + "I", k, role[0], (*turns, (role, ""))))
        if k < len(rows):
            _, role, text = rows[k]
            heapq.heappush(heap, (cost + 4, audit + "D", k + 1, last, turns))
            if fault[k] not in ("blank", "duplicate"):
                more = 3 if fault[k] == "truncated" else 0
                if (role[:1] == "s" and not last) or role[:1] in [r[0] for r in free]:
                    heapq.heappush(heap, (cost + more, audit + "K", k + 1, role[:1], (*turns, (role, text))))
                for new in free:
                    heapq.heappush(heap, (cost + more + 3, audit + "R", k + 1, new[0], (*turns, (new, text))))
    raise AssertionError("no repair")


def repairs(rows):
    out = {}
    for conv_id, held in damaged(rows).items():
        fault = faults(held)
        turns = [t for t, _, _ in held if t is not None]
        initials = [r[:1] for _, r, _ in held]
        cost, audit, repaired = cheapest(held, fault)
        text = "\n".join(f"{r}:{t}" for r, t in repaired)
        out[conv_id] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *[fault.count(x) for x in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            cost, audit, hashlib.sha256(text.encode()).hexdigest(),
        )
    return out


def trie(rows):
    """(conv_id, depth) -> the other columns, from all prefixes of all rebuilt conversations."""
    held = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            held[conv_id].append((turn, role or "", text or ""))
    key = lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), hashlib.sha256(f"{len(x[1].encode())}:{x[1]}{x[2]}".encode()).hexdigest())
    turns = {c: [x[1:] for x in sorted(r, key=key)] for c, r in held.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (c % 100 if c >= 0 else -(-c % 100))
        seq = tuple(turns.get(first, [])[:h] + own[h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for seq in members:
        if seq:
            kids[seq[:-1]] += 1
    for seq, m in members.items():
        for d in range(len(seq) + 1):
            leaves[seq[:d]] += not kids[seq]
            saved[seq[:d]] += (len(m) - 1) * len(seq[-1][1]) if seq else 0
    out = {}
    for seq, m in members.items():
        digest = hashlib.sha256(",".join(map(str, sorted(ends[seq]))).encode()).hexdigest()
        assert (min(m), len(seq)) not in out
        out[min(m), len(seq)] = (min(members[seq[:-1]]) if seq else None, len(m), kids[seq], leaves[seq], saved[seq], digest)
    return out
