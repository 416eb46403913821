"""BAM files written here, read in splits of any size."""

import random
import struct
import zlib

import pytest

from isoforge.sources import bam, text


def block(data):
    z = zlib.compressobj(6, zlib.DEFLATED, -15)
    own = z.compress(data) + z.flush()
    return b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff" + struct.pack("<H2sHH", 6, b"BC", 2, len(own) + 25) + own + struct.pack("<II", zlib.crc32(data), len(data))


def record(name, tags, seq=50, flag=0):
    own = name.encode() + b"\0" + struct.pack("<I", seq << 4) + bytes([0x12]) * ((seq + 1) // 2) + b"\x20" * seq
    for tag, kind, value in tags:
        own += tag.encode() + kind.encode()
        own += value.encode() + b"\0" if kind in "ZH" else value if kind == "B" else struct.pack("<" + {"A": "c", "i": "i", "C": "B", "f": "f", "s": "h"}[kind], value)
    own = struct.pack("<iiBBHHHiiii", 0, 100, len(name) + 1, 60, 0, 1, flag, seq, -1, -1, 0) + own
    return struct.pack("<i", len(own)) + own


def write_bam(path, records, sizes, seed=0):
    """Blocks of random sizes; records run over their ends."""
    rng, text_ = random.Random(seed), b"@HD\tVN:1.6\n"
    data = b"BAM\x01" + struct.pack("<i", len(text_)) + text_ + struct.pack("<i", 1) + struct.pack("<i", 5) + b"chr1\0" + struct.pack("<i", 10**8) + b"".join(records)
    out, at = [], 0
    while at < len(data):
        n = rng.choice(sizes)
        out.append(block(data[at : at + n]))
        at += n
    path.write_bytes(b"".join(out) + block(b""))


def reads(sample, n, seed):
    rng, rows = random.Random(seed), []
    for i in range(n):
        tags = [("NM", "C", 3), ("AS", "f", 1.5), ("zb", "B", b"S" + struct.pack("<IHH", 2, 7, 9))]
        if i % 5:
            tags.append(("CB", "Z", f"CELL{i % 7}"))
        if i % 3:
            tags.append(("XM", "Z", f"{sample}U{i}"))
        rng.shuffle(tags)
        rows.append((f"m/{sample}/{i if i % 50 else 0}", tags, rng.choice([20, 300, 5000]) if i % 97 else 150_000, i % 16))
    return rows


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    out = tmp_path_factory.mktemp("bams")
    for sample, seed in (("S1", 1), ("S2", 2)):
        write_bam(out / f"{sample}.bam", [record(*r) for r in reads(sample, 400, seed)], [700, 9000, 40_000, 65_000], seed)
    return out


@pytest.mark.parametrize("split", [997, 20_011, 1 << 26])
def test_splits_of_any_size_give_the_same_rows(spark, folder, split):
    paths = [str(folder / f"{s}.bam") for s in ("S1", "S2")]
    got = bam.read_tagged_bam(spark, paths, ("CB", "XM", "zb", "AS"), split).collect()
    for p, (sample, seed) in zip(paths, (("S1", 1), ("S2", 2)), strict=True):
        own = sorted((r for r in got if r["path"] == p), key=lambda r: r["at"])
        truth = [(n, f, *({t: v for t, _, v in tags}.get(c) for c in ("CB", "XM"))) for n, tags, _, f in reads(sample, 400, seed)]
        assert [(r["read_name"], r["flag"], r["CB"], r["XM"]) for r in own] == truth
        assert {(r["zb"], r["AS"]) for r in own} == {("7,9", "1.5")} and len({r["at"] for r in own}) == 400


def test_association_equals_that_of_the_text(spark, folder, tmp_path):
    paths = [str(folder / f"{s}.bam") for s in ("S1", "S2")]
    got = {tuple(r) for r in bam.bam_association(spark, paths).collect()}
    truth = {}
    for sample, seed in (("S1", 1), ("S2", 2)):
        for name, tags, _, _ in reads(sample, 400, seed):
            own = {t: v for t, _, v in tags}
            if "CB" in own and "XM" in own:
                truth[sample, name] = (own["CB"], own["XM"])
    assert got == {(*k, *v) for k, v in truth.items()}
    lines = ["\t".join([n, *["x"] * 10, *(f"{t}:{k}:{v}" for t, k, v in tags if k == "Z")]) for n, tags, _, _ in reads("S1", 400, 1)]
    (tmp_path / "S1.sam").write_text("\n".join(lines) + "\n")
    cells = {(r["read_name"], r["CB"]) for r in text.read_sam_text(spark, str(tmp_path / "S1.sam")).collect()}
    assert cells == {(r["read_name"], r["CB"]) for r in bam.read_tagged_bam(spark, paths[0]).filter("CB IS NOT NULL").collect()}


def test_files_without_records_and_damaged_ones(spark, folder, tmp_path):
    write_bam(tmp_path / "none.bam", [], [4000])
    assert bam.read_tagged_bam(spark, str(tmp_path / "none.bam")).count() == 0
    raw = (folder / "S1.bam").read_bytes()
    (tmp_path / "cut.bam").write_bytes(raw[: len(raw) // 2])
    (tmp_path / "text.bam").write_bytes(b"no such format" * 10)
    for name in ("cut.bam", "text.bam"):
        with pytest.raises(Exception, match="block|BAM"):
            bam.read_tagged_bam(spark, str(tmp_path / name)).count()
