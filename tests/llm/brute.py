"""Plain Python versions of the fixed rules, for comparison with the Spark operators."""

import hashlib
import re

ASSIGN = r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def secret_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{['assign', 'access', 'hex'][k]}:{s}:{e}" for s, k, e in sorted(out)]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def pii_spans(text):
    def nums(m):
        return re.sub("[^0-9]", "", m[0])

    out = [f"email:{m.start()}:{m.end()}" for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [f"ip:{m.start()}:{m.end()}" for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [f"card:{m.start()}:{m.end()}" for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(nums(m)) <= 19 and luhn(nums(m))]
    out += [f"phone:{m.start()}:{m.end()}" for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(nums(m)) <= 15]
    return out


def sha(spans):
    return hashlib.sha256(",".join(spans).encode()).hexdigest()
