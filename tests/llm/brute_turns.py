"""Plain Python forms of the operators on conversations, one conversation at a time."""

import hashlib
import re
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]")
PATTERN = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _none(value):
    return " " if value is None else str(value)


def _by_turn(rows):
    """(turn, role, text, ...) in order; nulls first, ties as the operators take them."""
    def key(row):
        turn, role, text = row[:3]
        full = f"{len(role.encode())}:{role}{len(text.encode())}:{text}"
        return (turn is not None, turn or 0, role[:64].encode(), text[:64].encode(), hashlib.sha256(full.encode()).digest()[:16])

    return sorted(rows, key=key)


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        fate = zlib.crc32(f"{_none(conv)}:{_none(turn)}".encode()) % 20
        kept = out[conv]
        role, text = _none(role), _none(text)
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        kept += [] if fate == 0 else [(turn, role, text)] * (2 if fate == 3 else 1)
    return {conv: _by_turn(turns) for conv, turns in out.items()}


def _cheapest(turns, kinds):
    """(cost, audit, repaired) by forward search over all states, keeping the least audit."""
    best = {"": (0, "", ())}

    def better(table, state, cost, audit, lines):
        if state not in table or (cost, audit) < table[state][:2]:
            table[state] = (cost, audit, lines)

    def with_inserts(table):
        for _ in range(3):
            for state, (cost, audit, lines) in list(table.items()):
                for letter, role in (("u", "user"), ("a", "assistant")):
                    if (state, letter) in PATTERN:
                        better(table, PATTERN[state, letter], cost + 2, audit + "I", (*lines, f"{role}:"))
        return table

    for (_, role, text), kind in zip(turns, kinds):
        new = {}
        for state, (cost, audit, lines) in with_inserts(best).items():
            better(new, state, cost + 3, audit + "D", lines)
            if kind in ("blank", "duplicate"):
                continue
            extra = kind == "truncated"
            kept = state if role == "" else PATTERN.get((state, role[0]))
            if kept is not None:
                better(new, kept, cost + extra, audit + "K", (*lines, f"{role}:{text}"))
            for letter, name in (("u", "user"), ("a", "assistant")):
                if (state, letter) in PATTERN:
                    better(new, PATTERN[state, letter], cost + 2 + extra, audit + "R", (*lines, f"{name}:{text}"))
        best = new
    best = with_inserts(best)
    return min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])


def brute_repairs(rows):
    """All columns of the report, for (conv_id, turn, role, text)."""
    out = []
    for conv, turns in damaged(rows).items():
        kinds, seen = [], set()
        for _, role, text in turns:
            words = WORD.findall(text)
            kinds.append(
                "blank" if not words else "duplicate" if (role, text) in seen else "whole" if words[-1] in ".!?" else "truncated"
            )
            seen.add((role, text))
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:])]
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        cost, audit, lines = _cheapest(turns, kinds)
        counts = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, _sha("\n".join(lines))))
    return out


def brute_trie(rows):
    """All columns of the trie, for (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn, role or "", text or ""))
    own = {c: [t[1:] for t in _by_turn(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        built[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(set)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        last = len(node[-1][1].encode()) if node else 0
        saved[node] = (len(members[node]) - 1) * last + sum(saved[k] for k in children[node])
    return [
        (
            min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), len(children[node]), leaves[node], saved[node],
            _sha(",".join(str(c) for c in sorted(cs) if len(built[c]) == len(node))),
        )
        for node, cs in members.items()
    ]
