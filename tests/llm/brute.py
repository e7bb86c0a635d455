"""Plain Python versions of quality rules and decontamination."""

import re

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    words = SPACE.findall(text)
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i:i + 5]), []).append(i)
    repeated = {j for v in windows.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    upper = set("ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÄÇÈÉÊËÍÎÏÑÓÔÖÙÚÛÜ")
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated), "n_lines": len(lines),
            "n_upper": sum(c in upper for c in text)}


def failures(m):
    rules = [m["n_words"] < 10, 100 * m["n_repeat_words"] > 20 * m["n_words"], 10 * m["n_symbols"] > m["n_words"],
             10 * m["n_dup_lines"] > 4 * m["n_lines"], m["word_chars"] < 2 * m["n_words"], m["word_chars"] > 15 * m["n_words"],
             2 * m["n_upper"] > m["word_chars"]]
    return sum(1 << i for i, bad in enumerate(rules) if bad)


def bench_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def contamination(text, items):
    """(hit words, item ids) of a text; items: (id, text)."""
    words = bench_words(text)
    hit, found = set(), set()
    for key, item in items:
        w = bench_words(item)
        n = min(10, len(w))
        windows = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i:i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(key)
    return len(hit), found
