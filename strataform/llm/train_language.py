"""Train the language network by backpropagation through time, in numpy.

    python -m strataform.llm.train_language DOCUMENTS.parquet [WEIGHTS.npz]

Reads a bounded sample of labelled rows (``MAX_ROWS``), trains once on the labels
as they are, drops rows whose label the network contradicts or whose sentences
disagree, trains again and writes the weights beside ``language``.  All seeds are
fixed, so the command gives the same weights from the same rows.  Text that holds
no language is derived from the rows' own words and names by rule.
"""

from __future__ import annotations

import random
import re
import string
import sys

import numpy as np

from strataform.llm.language import LANGUAGES, NONE, PAD, WEIGHTS, Network, label_code, sentences, spell, windows

#: Labelled rows used at most.
MAX_ROWS = 12_000
SIZE, EMBEDDING = 16, 12
LANES, RATE, EPOCHS = 256, 3e-3, (3, 18)
PER_CLASS = 6_000
#: Windows of a row, at most.
ROW_WINDOWS = 12


def initial(rng: np.random.Generator) -> dict[str, np.ndarray]:
    w = {"embedding": rng.normal(0, 0.5, (256, EMBEDDING)), "out_w": rng.normal(0, 0.2, (NONE + 1, 2 * SIZE)), "out_b": np.zeros(NONE + 1)}
    for side in ("forward", "backward"):
        w[f"{side}_w"] = rng.normal(0, 0.3, (3 * SIZE, EMBEDDING))
        w[f"{side}_u"] = rng.normal(0, 0.25, (3 * SIZE, SIZE))
        w[f"{side}_b"] = np.concatenate([np.full(SIZE, 0.6), np.full(SIZE, 0.35), np.zeros(SIZE)])
    return {k: v.astype(np.float32) for k, v in w.items()}


def gradients(w: dict[str, np.ndarray], symbols: np.ndarray, target: np.ndarray, size: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Loss per position and its gradients for a batch ``symbols`` (positions, lanes)."""
    steps, lanes = symbols.shape
    n, f = SIZE, np.float32
    inside = (np.arange(steps)[:, None] < size).astype(f)
    x = np.where(symbols == PAD, 0, symbols)
    grad = {k: np.zeros_like(v) for k, v in w.items()}
    kept, states = {}, {}
    for side in ("forward", "backward"):
        table = w[f"{side}_w"] @ w["embedding"].T + w[f"{side}_b"][:, None]
        u, h = w[f"{side}_u"], np.zeros((n, lanes), f)
        store, out = [], np.empty((steps, n, lanes), f)
        for t in range(steps) if side == "forward" else range(steps - 1, -1, -1):
            g, a = table[:, x[t]], u @ h
            raw = g[: 2 * n] + a[: 2 * n]
            gates = np.clip(raw, 0, 1)
            r, z = gates[:n], gates[n:] * inside[t]
            new = np.tanh(g[2 * n :] + r * a[2 * n :])
            store.append((t, h, raw, r, z, new, a[2 * n :]))
            h = h + z * (new - h)
            out[t] = h
        kept[side], states[side] = store, out
    both = np.concatenate([states["forward"], states["backward"]], axis=1)
    logits = np.einsum("ch,thb->tcb", w["out_w"], both) + w["out_b"][None, :, None]
    logits -= logits.max(1, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(1, keepdims=True)
    count = inside.sum()
    one = np.zeros_like(p)
    one[:, target, np.arange(lanes)] = 1
    loss = -(np.log(p[:, target, np.arange(lanes)] + 1e-9) * inside).sum() / count
    d = (p - one) * (inside / count)[:, None, :]
    grad["out_w"] = np.einsum("tcb,thb->ch", d, both)
    grad["out_b"] = d.sum((0, 2))
    d_both = np.einsum("ch,tcb->thb", w["out_w"], d)
    for side in ("forward", "backward"):
        d_out = d_both[:, :n] if side == "forward" else d_both[:, n:]
        u, dh = w[f"{side}_u"], np.zeros((n, lanes), f)
        d_table = np.zeros((steps, 3 * n, lanes), f)
        for t, h, raw, r, z, new, an in reversed(kept[side]):
            dh = dh + d_out[t]
            dz, dn = dh * (new - h), dh * z * (1 - new * new)
            open_ = (raw > 0) & (raw < 1)
            # A gate beyond its range still lets a little of the gradient back.
            slope = np.where(open_, 1.0, 0.02).astype(f)
            dr = dn * an * slope[:n]
            dz = dz * inside[t] * slope[n:]
            da = np.concatenate([dr, dz, dn * r])
            d_table[t] = np.concatenate([dr, dz, dn])
            grad[f"{side}_u"] += da @ h.T
            dh = dh * (1 - z) + u.T @ da
        order = np.argsort(x.ravel(), kind="stable")
        seen, first = np.unique(x.ravel()[order], return_index=True)
        by_symbol = np.zeros((256, 3 * n), f)
        by_symbol[seen] = np.add.reduceat(d_table.transpose(0, 2, 1).reshape(-1, 3 * n)[order], first)
        grad[f"{side}_b"] = by_symbol.sum(0)
        grad[f"{side}_w"] = by_symbol.T @ w["embedding"]
        grad["embedding"] += by_symbol @ w[f"{side}_w"]
    return float(loss), grad


def train(examples: list[tuple[bytes, int]], epochs: int, w: dict[str, np.ndarray] | None = None, seed: int = 0, say=print) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    w = w or initial(rng)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    step, total = 0, epochs * (len(examples) // LANES)
    for epoch in range(epochs):
        lengths = np.array([len(d) for d, _ in examples]) + rng.integers(0, 12, len(examples))
        order = np.argsort(lengths, kind="stable")
        batches = [order[i : i + LANES] for i in range(0, len(order) - LANES + 1, LANES)]
        losses = []
        for i in rng.permutation(len(batches)):
            rows = [examples[k] for k in batches[i]]
            size = np.array([len(d) for d, _ in rows])
            symbols = np.full((size.max(), len(rows)), PAD)
            for k, (d, _) in enumerate(rows):
                symbols[: len(d), k] = np.frombuffer(d, np.uint8)
            loss, grad = gradients(w, symbols, np.array([y for _, y in rows]), size)
            norm = np.sqrt(sum(float((v * v).sum()) for v in grad.values()))
            if not np.isfinite(norm) or norm > 100:  # an exploded batch teaches nothing
                continue
            losses.append(loss)
            step += 1
            rate, clip = RATE * (1 - 0.95 * step / max(1, total)), min(1.0, 1.0 / (norm + 1e-9))
            for k, v in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * clip * v
                second[k] = 0.99 * second[k] + 0.01 * (clip * v) ** 2
                w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
        say(f"epoch {epoch + 1}: {np.mean(losses):.4f}")
    return w


#: Rows with a smaller share of letters and blanks teach no language.
LEAST_SPELLED = 0.75

_NAME = re.compile(r"(?<=[^\W\d_][ ])[^\W\d_a-zß-ÿ][^\W\d_]+(?: [^\W\d_a-zß-ÿ][^\W\d_]+)*")


def names_of(text: str) -> list[str]:
    """Runs of capitalised words within sentences: names, in languages that do not write nouns so."""
    return _NAME.findall(text)


def made(rng: random.Random, words: list[str], names: list[str]) -> str:
    """A line that holds no language, derived from the words and names of the rows by rule.

    Words with their letters shuffled, drawn from all letters alike or by their
    frequency, cut to their first letters, or sent through a channel that loses
    letters; vowels or consonants alone; and names without a sentence.
    """
    some = lambda low, high: [rng.choice(words) for _ in range(rng.randint(low, high))]
    shuffled = lambda w: "".join(rng.sample(w, len(w)))
    kind = rng.randrange(8)
    if kind == 0:
        return " ".join(shuffled(w) for w in some(3, 16))
    if kind == 1:
        pool = "".join(some(30, 30))
        return " ".join("".join(rng.choice(pool) for _ in range(rng.randint(1, 11))) for _ in range(rng.randint(2, 14)))
    if kind == 2:
        alphabet = string.ascii_lowercase[: rng.choice([6, 12, 26, 26])]
        return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(1, rng.choice([3, 8, 40])))) for _ in range(rng.randint(1, 16)))
    if kind == 3:
        return " ".join(w[: rng.randint(1, 4)] for w in some(3, 16))
    if kind == 4:
        vowels = rng.random() < 0.3
        return " ".join(x for w in some(4, 20) if (x := "".join(c for c in w if (c in "aeiouy") == vowels)))
    if kind == 5 and names:
        return " ".join(rng.choice(names) for _ in range(rng.randint(1, 8)))
    if kind == 6 and names:
        # Names with what is left of numbers and codes beside them.
        return " ".join(x for _ in range(rng.randint(1, 6)) for x in (rng.choice(names), "".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(1, 4))) if rng.random() < 0.5 else "") if x)
    out = []
    for c in " ".join(some(5, 16)):
        x = rng.random()
        out.append(rng.choice(string.ascii_lowercase) if x < 0.2 else "" if x < 0.4 else c)
        if rng.random() < 0.2:
            out.append(" ")
    return "".join(out)


def listed(rng: random.Random, phrases: list[bytes]) -> bytes:
    """Phrases as a list, menu or table has them."""
    number = lambda: f"{rng.randint(1, 90000)}{rng.choice([' ', ' | ', ';'])}{rng.random() * 500:.2f}{rng.choice([' ', ' | ', ';'])}{rng.choice('+-')}{rng.random() * 9:.1f}%"
    mark = rng.choice([" | ", ", ", ",", " / ", " #", " - ", " * ", "; ", " > ", " » "])
    kind = rng.randrange(3)
    out = ""
    for _ in range(rng.randint(2, 6)):
        phrase = re.sub(r"[^\w\s'’-]+", " ", rng.choice(phrases).decode("utf-8", "ignore")).strip()
        out += phrase + {0: mark, 1: f" {rng.choice(['|', ';', ''])} {number()} ", 2: rng.choice([" ", " » ", " > ", f" ({rng.randint(1, 90)}) "])}[kind]
    return spell(out)[:220]


def prepare(rows: list[tuple[str, str | None]], seed: int = 0) -> list[tuple[list[bytes], int]]:
    """Windows and class of each row with a usable label.

    Left out are rows made of digits and marks for a good part and rows with over
    0.3 of their words of one letter.
    """
    rng = random.Random(seed)
    rows = list(rows)
    rng.shuffle(rows)
    out = []
    for text, label in rows[:MAX_ROWS]:
        code = label_code(label)
        words = re.findall(r"[^\W\d_]+", text or "")
        shown = sum(not c.isspace() for c in text or "")
        if not code or not words or sum(map(len, words)) < LEAST_SPELLED * shown or sum(len(x) == 1 for x in words) > 0.3 * len(words):
            continue
        data = [w for s, _ in sentences(text) for w in windows(spell(s))]
        rng.shuffle(data)
        out.append((data[:ROW_WINDOWS], LANGUAGES.index(code)))
    return out


def agreeing(network: Network, documents: list[tuple[list[bytes], int]]) -> list[tuple[list[bytes], int]]:
    """Rows whose windows hold the language of their label, as far as they hold one."""
    pooled = network.pool([x for d, _ in documents for x in d])
    kept, at = [], 0
    for data, y in documents:
        p = pooled[at : at + len(data)]
        at += len(data)
        if len(data) and (y == NONE or p[:, :NONE].sum(0).argmax() == y and (p[:, :NONE].argmax(1) == y).mean() >= 0.7):
            kept.append((data, y))
    return kept


def main(path: str, out: str = str(WEIGHTS)) -> None:
    import pyarrow.parquet as pq

    table = pq.read_table(path, columns=["text", "lang"])
    rows = list(zip(table["text"].to_pylist(), table["lang"].to_pylist(), strict=True))
    documents = prepare(rows)
    held, documents = documents[: len(documents) // 10], documents[len(documents) // 10 :]
    words = [w for d, _ in documents[:2000] for x in d for w in x.decode(errors="replace").split()]
    # German writes all nouns like names, so its rows name none.
    names = [n.lower() for t, label in rows[:MAX_ROWS] if t and label_code(label) not in (None, "de") for n in names_of(t)]
    rng = random.Random(1)
    w = None
    for stage, epochs in enumerate(EPOCHS):
        by_class: dict[int, list[bytes]] = {}
        for data, y in documents:
            by_class.setdefault(y, []).extend(data)
        by_class[NONE] = [x for _ in range(PER_CLASS) for x in windows(spell(made(rng, words, names)))]
        examples = []
        for y, data in sorted(by_class.items()):
            rng.shuffle(data)
            part = data[:PER_CLASS]
            examples += [(x, y) for x in part]
            if y != NONE:
                phrases = [b" ".join(x.split()[: rng.randint(2, 5)]) for x in part if b" " in x]
                examples += [(x, y) for x in phrases[: PER_CLASS // 6]]
                examples += [(listed(rng, phrases), y) for _ in range(PER_CLASS // 3)]
        examples = [(x, y) for x, y in examples if len(x) >= 3]
        print(f"stage {stage}: {len(documents)} rows, {len(examples)} windows", flush=True)
        w = train(examples, epochs, w, seed=stage, say=lambda x: print(x, flush=True))
        network = Network(w)
        documents = agreeing(network, documents)
        np.savez_compressed(out, **{k: v.astype(np.float32) for k, v in w.items()})
    right = sum(network.pool(d)[:, :NONE].sum(0).argmax() == y for d, y in held if d)
    print(f"held out: {right} of {sum(1 for d, _ in held if d)} rows agree with their labels, some of which are wrong")
    fresh = random.Random(99)
    none = [x for _ in range(2000) for x in windows(spell(made(fresh, words, names)))]
    print(f"held out: {(network.pool(none).argmax(1) == NONE).mean():.3f} of {len(none)} new lines without language are found to have none")


if __name__ == "__main__":
    main(*sys.argv[1:])
