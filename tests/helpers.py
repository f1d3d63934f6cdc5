"""A small run of our own: random designs, paired reads, index reads and the tables that go with them."""

import gzip
import os
import random

SWAP = str.maketrans("ACGTN", "TGCAN")
LEFT, RIGHT = "GACTGACCTGATTCAGGCATCCAGT", "CTTGGACCATCGAATGCCTAGTTCG"
COUNTS = [200, 160, 130, 100, 80, 60, 50, 40, 30, 20] + [10] * 8 + [0, 0]
STRAY = [20, 16, 13, 10, 8] + [2] * 13 + [0, 0]


def rc(s):
    return s.translate(SWAP)[::-1]


def fastq(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt") as out:
        for head, seq, qual in rows:
            out.write(f"@{head}\n{seq}\n+\n{qual}\n")


def make_run(root, seed=7):
    rnd = random.Random(seed)
    dna = lambda n: "".join(rnd.choice("ACGT") for _ in range(n))
    targets = [dna(80 + (i * 7) % 51) for i in range(20)]
    genome = dna(5386)

    def pair(amplicon, name, index):
        one = (dna(rnd.randrange(6)) + amplicon + dna(150))[:150]
        two = (dna(rnd.randrange(6)) + rc(amplicon) + dna(150))[:150]
        return tuple((f"RUN:1:F:1:1:1:{name} {k}:N:0:{index}", s, "I" * 150) for k, s in ((1, one), (2, two)))

    def sample(counts, index, wrong):
        rows = []
        for i, n in enumerate(counts):
            for j in range(n):
                a, b = pair(LEFT + targets[i] + rc(RIGHT), f"{i}_{j}_{index[:3]}", index)
                if wrong and j == 0:
                    at = a[1].index(LEFT) + len(LEFT) + 20
                    a = (a[0], a[1][:at] + ("A" if a[1][at] != "A" else "C") + a[1][at + 1 :], a[2])
                rows.append((a, b))
        return rows

    pdna, und = sample(COUNTS, "ACGTACGT+TGCATGCA", True), sample(STRAY, "ACGTACNT+TGCATGCA", False)
    ring = genome * 2
    for k in range(50):
        at = rnd.randrange(len(genome))
        und.append(tuple((f"RUN:1:F:1:1:1:x{k} {m}:N:0:NNNNNNNN", s, "I" * 150) for m, s in ((1, ring[at : at + 150]), (2, rc(ring[at + 150 : at + 300])))))
    for name, rows in (("pDNA", pdna), ("Undetermined", und)):
        for k in (0, 1):
            fastq(f"{root}/fastq/{name}_S1_L001_R{k + 1}_001.fastq.gz", [r[k] for r in rows])
    fastq(f"{root}/fastq/Run_S1_L001_I1_001.fastq.gz", [(f"i{k} 1", "ACGTACGT" if k < 180 else "ACGTACNT", "IIIIIIII") for k in range(200)])
    for name, ends in (("design", ("", "")), ("oligo", (LEFT[-15:], rc(RIGHT)[:15]))):
        with open(f"{root}/{name}.csv", "w") as out:
            out.write("Variant_ID,target_sequence\n" + "".join(f"V{i:02d},{ends[0]}{t}{ends[1]}\n" for i, t in enumerate(targets)))
    with open(f"{root}/phix.fasta", "w") as out:
        out.write(">phix\n" + "\n".join(genome[i : i + 70] for i in range(0, len(genome), 70)) + "\n")
    with open(f"{root}/sheet.csv", "w") as out:
        out.write("[Header]\nx,y\n[Data]\nSample_ID,index,index2\npDNA,ACGTACGT,TGCATGCA\n")
    with open(f"{root}/unknown.csv", "w") as out:
        out.write("index,count\nACGTACNT+TGCATGCA,93\nACGTACAT-TGCATGCA,7\n")
    with open(f"{root}/run.ini", "w") as out:
        out.write(
            f"[input]\ninput_dir = fastq\nreference = design.csv\noutdir = out\nsample_sheet = sheet.csv\ntop_unknown = unknown.csv\n"
            f"[amplicon]\nleft_primer = {LEFT}\nright_primer = {RIGHT}\n[control_qc]\nphix_reference = phix.fasta\nexpected_phix_percent = 5\n"
        )
    return targets


def naive_match(e, refs, signature, most):
    """The decision table, written plainly: e is a dict of evidence, refs a list of sequences."""
    for full in e["fulls"]:
        if full in refs:
            return "exact", refs.index(full), full, 0, 0
    near = lambda a, b: sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    chosen = set()
    for k in sorted({signature, min(12, signature)}, reverse=True):
        p, s = e["prefix"] or "", e["suffix"] or ""
        ps = {i for i, r in enumerate(refs) if len(r) >= k and len(p) >= k and near(r[:k], p[:k])}
        ss = {i for i, r in enumerate(refs) if len(r) >= k and len(s) >= k and near(r[-k:], s[-k:])}
        chosen = (ps & ss) or (ps | ss)
        if chosen:
            break
    if not chosen:
        return ("no_candidate" if e["left_anchor"] or e["right_anchor"] else "anchor_missing"), None, None, None, 0
    scored = []
    for i in chosen:
        n = len(refs[i])
        base, qual, apart = [None] * n, [-1] * n, 0
        for j, (b, q) in enumerate(zip((e["prefix"] or "")[:n], (e["prefix_q"] or "")[:n], strict=True)):
            base[j], qual[j] = b, max(0, ord(q) - 33)
        s, sq = (e["suffix"] or "")[-n:], (e["suffix_q"] or "")[-n:]
        for j, (b, q) in enumerate(zip(s, sq, strict=True), n - len(s)):
            q = max(0, ord(q) - 33)
            if base[j] is None:
                base[j], qual[j] = b, q
            elif base[j] != b:
                apart += 1
                if q > qual[j]:
                    base[j], qual[j] = b, q
        got = [b is not None for b in base]
        if sum(got) / n >= 0.95:
            scored.append((sum(g and b != r for g, b, r in zip(got, base, refs[i], strict=True)), apart, i, "".join(b or "N" for b in base)))
    if not scored:
        return "insufficient_evidence", None, None, None, 0
    scored.sort()
    d, apart, i, seq = scored[0]
    if sum(x[0] == d for x in scored) > 1:
        return "ambiguous", None, seq, d, apart
    kind = "exact" if d == 0 else "near" if d <= most else "too_many_mismatches"
    return kind, i if kind != "too_many_mismatches" else None, seq, d, apart
