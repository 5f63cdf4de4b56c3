"""Decoders on blobs built by hand, listings, label files and configurations."""

import json
import struct

import numpy as np
import pytest

from quarry.operators import pixels
from quarry.sources import atlas, bundles, documents, files, sinks

PATHS = ["Mob/0100100/move/0", "Mob/0100100/stand/0", "Mob/0100100/die1/0"]


def atlas_blob(version=5, pages=(0,), names=None, boxes=((0, 0, 4, 4), (4, 0, 4, 4))):
    names = [n.encode() for n in (names or [atlas.sprite_key(p) for p in PATHS])]
    blob = bytearray(b"WZSS" + struct.pack("<i", version) + struct.pack(f"<{len(pages)}i", *pages))
    at = {}
    for key, kind, values in (
        ("pivot", "2f", (0.25, 0.75)), ("box", f"{4 * len(boxes)}i", sum(boxes, ())), ("direct", "10i", (0, 0, 0, 0, 0, 1, 1, 0, 1, 0)), ("link", "4i", (2, -1, -1, 1)),
        ("cuts", "4i", (0, 32, 64, 96)),
    ):
        at[key] = len(blob)
        blob += struct.pack("<" + kind, *values)
    data = len(blob)
    blob += b"".join(names)
    header = (len(pages), 8, 0, 8, 8, 1, at["pivot"], len(boxes), at["box"], 2, at["direct"], 1, at["link"], 3, data, at["cuts"], 0, 0, 0)
    return bytes(32) + struct.pack("<19i", *header) + struct.pack("<i", len(blob)) + bytes(blob)


def test_sprite_keys():
    assert [atlas.sprite_key(p) for p in PATHS] == ["455988fe32c7de6f759a362d11b8b60a", "56ba3215448792d2f9f8dc56d4befbb2", "31990500ec7c5bde91131c087f3bba54"]


@pytest.mark.parametrize("version", [4, 5])
def test_atlas_lookup_and_crop(version):
    a = atlas.read_atlas(atlas_blob(version), 3)
    assert [a.find(p) for p in PATHS] == [0, 1, 2] and a.resolve(2) == 1 and a.pivot[1, 0] == 0.25
    page = np.zeros((4, 8, 4), np.uint8)
    page[:, :4], page[:, 4:] = (255, 0, 0, 255), (0, 0, 255, 255)
    assert a.crop(2, [page])[0, 0].tolist() == [0, 0, 255, 255]
    with pytest.raises(atlas.AtlasError):
        a.find("Mob/0100100/unknown/0")
    with pytest.raises(atlas.AtlasError):
        a.crop(1, [np.zeros((4, 4, 4), np.uint8)])


def test_atlas_pages_are_permuted():
    a = atlas.read_atlas(atlas_blob(pages=(1, 0)), 3)
    red, blue = np.full((4, 8, 4), (255, 0, 0, 255), np.uint8), np.full((4, 8, 4), (0, 0, 255, 255), np.uint8)
    assert a.crop(0, [red, blue])[0, 0].tolist() == [0, 0, 255, 255]


@pytest.mark.parametrize("raw", [b"", b"no magic here", b"WZSS" + struct.pack("<i", 9), b"WZSS" + struct.pack("<i", 5), atlas_blob(pages=(0, 2)), atlas_blob(boxes=((0, 0, 0, 4), (4, 0, 4, 4)))])
def test_atlas_rejects(raw):
    with pytest.raises(atlas.AtlasError):
        atlas.read_atlas(raw, 3)


@pytest.mark.parametrize("newer", [False, True])
def test_atlas_without_header(newer):
    boxes = [(0, 0, 2, 3), (2, 0, 5, 1)]
    rows = [(0, 0, 0, 0, 0), (1, 1, 3, 1, 0)]
    links = [(-1, -1, 1, 2), (-1, -1, 2, 3)] if newer else [(2, -1, -1, 1), (3, 5, -1, 2)]
    raw = b"WZSS" + struct.pack("<2i", 4, 99) + b"".join(struct.pack("<4i", *b) for b in boxes) + b"".join(struct.pack("<5i", *r) for r in rows) + bytes(4) + b"".join(struct.pack("<4i", *r) for r in links)
    a = atlas.read_atlas(raw + bytes(40), 4)
    assert a.page.tolist()[:2] == [0, 3] and a.box[1].tolist() == [2, 0, 5, 1] and a.resolve(3) == 1


def test_alias_cycle():
    a = atlas.read_atlas(atlas_blob(), 3)
    a.alias[1] = 2
    with pytest.raises(atlas.AtlasError):
        a.resolve(1)


def test_decoded_frames(spark):
    rows = [("good", bytearray(atlas_blob()), 3), ("bad", bytearray(b"nothing"), 1)]
    frames = atlas.decode_frames(spark.createDataFrame(rows, "asset string, content binary, sprites int")).cache()
    assert frames.where("asset = 'good'").count() == 3
    assert "magic" in frames.where("asset = 'bad'").first().error
    targets = {r.frame: r.target for r in atlas.resolved_aliases(frames).collect()}
    assert targets == {0: 0, 1: 1, 2: 1}


def test_aliases_to_the_end(spark):
    """Chains of any length, more than a million frames, targets that are in no table, and a circle."""
    frames = lambda n, alias: spark.range(n).selectExpr("'a' as asset", "cast(id as int) as frame", f"cast({alias} as int) as alias_of", "cast(null as string) as error")
    long = atlas.resolved_aliases(frames(200, "id - 1")).collect()
    assert len(long) == 200 and {r.target for r in long} == {0}
    many = atlas.resolved_aliases(frames(1_100_000, "if(id % 4 = 3, id - 1, -1)"))
    assert many.where("target = if(frame % 4 = 3, frame - 1, frame)").count() == many.count() == 1_100_000
    assert {r.target for r in atlas.resolved_aliases(frames(2, "99")).collect()} == {99}
    with pytest.raises(Exception, match="without an end"):
        atlas.resolved_aliases(frames(3, "if(id = 0, -1, 3 - id)")).collect()


def pool(strings, pad=0):
    data = b"".join(s.encode() + b"\0" for s in strings)
    cuts = np.cumsum([0, *[len(s.encode()) + 1 for s in strings]]).tolist()
    return data + bytes(-len(data) % 4 + pad) + struct.pack(f"<{len(cuts)}i", *cuts), len(data)


def document(header):
    keys, paths, strings = ["root", "a", "b", "pic", "pos"], [f"p{i}" for i in range(9)], ["hello", "wörld"]
    nodes = [
        (2, 0, 0, 1, 6, -1, 8, -1), (6, 1, 0, -1, 0, 0, 0, 0), (6, 1, 1, -1, 0, 0, 0, 0), (5, 2, 1, -1, 0, 0, 0, 0),
        (11, 2, 1, -1, 0, 0, 0, 0), (18, 3, 0, 7, 1, 0, 0, 0), (8, 0, 0, -1, 0, 0, 0, 0), (14, 4, 0, -1, 0, 5, 0, 0),
    ]
    body = b"WZJS" + struct.pack("<i", 5) + b"".join(struct.pack("<8i", *n) for n in nodes)
    at = {"bool": len(body)}
    body += struct.pack("<2h", 0, 1)
    at["int"] = len(body)
    body += struct.pack("<2i", 7, -9)
    at["float"] = len(body)
    body += struct.pack("<f", 0.5)
    at["vector"] = len(body)
    body += struct.pack("<2f", 1.5, -2.0)
    for name, s in (("key", keys), ("path", paths), ("value", strings)):
        at[name] = len(body)
        part, _ = pool(s)
        body += part
        at[name + "_cuts"] = len(body) - 4 * (len(s) + 1)
    if not header:
        return body
    h = [0] * 36
    h[0], h[1], h[8:12], h[14:18] = len(nodes), 8, [2, at["bool"], 2, at["int"]], [1, at["float"], 1, at["vector"]]
    h[26:35] = [len(keys), at["key"], at["key_cuts"], len(paths), at["path"], at["path_cuts"], len(strings), at["value"], at["value_cuts"]]
    h[35] = len(body)
    return struct.pack("<36i", *h) + body


@pytest.mark.parametrize("header", [True, False])
def test_document(header):
    tree = documents.Document(document(header)).tree()
    assert tree == {"root": {"a": [7, -9], "b": [True, "wörld"], "pic": {"$sprite": {"pos": {"x": 1.5, "y": -2.0}}}, "root": 0.5}}


def test_documents_in_spark(spark):
    rows = [("good", bytearray(document(True))), ("old", bytearray(b"WZJS" + struct.pack("<i", 4))), ("none", bytearray(b"x"))]
    got = {r.asset: r for r in documents.decode_json(spark.createDataFrame(rows, "asset string, content binary")).collect()}
    assert json.loads(got["good"].json)["root"]["a"] == [7, -9] and got["old"].json is None and "magic" in got["none"].error


def test_footholds(spark):
    tree = {"foothold": {"0": {"1": {"5": {"x1": 1, "y1": 2, "x2": 3, "y2": 4}, "6": {"x1": 1}}}, "1": {"0": {"5": {"x1": 9, "y1": 9, "x2": 9, "y2": 9}}}}}
    df = spark.createDataFrame([("m", json.dumps(tree))], "map_id string, json string")
    assert [tuple(r) for r in documents.footholds(df).collect()] == [("m", "5", 9, 9, 9, 9)]


def test_config(tmp_path):
    good = "client_root: a\noutput_root: b\ncache_dir: c\nseed: 1\nimage: {width: 1280, height: 224}\nsplits: {train: 1}\n"
    (tmp_path / "a.yml").write_text(good)
    assert files.load_config(tmp_path / "a.yml")["seed"] == 1
    (tmp_path / "b.yml").write_text(good.replace("224", "200"))
    (tmp_path / "c.yml").write_text(good.replace("seed: 1\n", ""))
    for name in "bc":
        with pytest.raises(ValueError):
            files.load_config(tmp_path / f"{name}.yml")


def test_label_files_and_listing(spark, tmp_path):
    rows = [("train", "train_000000", "0 0.1 0.2 0.3 0.4\n1 0.5 0.5 0.1 0.1"), ("val", "val_000000", "")]
    sinks.write_label_files(spark.createDataFrame(rows, "split string, stem string, body string"), tmp_path / "labels")
    lines = files.label_lines(spark, str(tmp_path / "labels")).collect()
    assert [(r.line_no, r.line) for r in lines] == [(0, "0 0.1 0.2 0.3 0.4"), (1, "1 0.5 0.5 0.1 0.1")]
    assert files.listing(spark, str(tmp_path / "labels"), "*.txt").count() == 2
    sinks.data_yaml(tmp_path / "data.yaml", ["a", "b"], ["monster", "player"])
    assert "b/images/val" in (tmp_path / "data.yaml").read_text()


def test_image_headers(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(pixels.png(np.zeros((7, 5, 4), np.uint8)))
    jpeg = b"\xff\xd8\xff\xe0\x00\x10JFIF\0\1\1\0\0\1\0\1\0\0" + b"\xff\xc0\x00\x11\x08\x00\xe0\x05\x00\x03" + b"\0" * 9 + b"\xff\xd9"
    (tmp_path / "b.jpg").write_bytes(jpeg)
    (tmp_path / "c.bin").write_bytes(b"??")
    got = {r.path.rsplit("/", 1)[1]: (r.format, r.width, r.height) for r in files.image_headers(spark, str(tmp_path)).collect()}
    assert got == {"a.png": ("PNG", 5, 7), "b.jpg": ("JPEG", 1280, 224), "c.bin": (None, None, None)}


def test_manifest_and_coco(spark, tmp_path):
    rows = spark.createDataFrame([("train", "s0", 1), ("val", "s1", 2)], "split string, stem string, n int")
    sinks.write_manifest(rows, str(tmp_path / "m"))
    sinks.write_manifest(rows, str(tmp_path / "m"))
    assert files.manifest(spark, str(tmp_path / "m"), "stem string, n int, split string").count() == 4
    images = spark.createDataFrame([("train", 1, "a.jpg", 1280, 224)], "split string, coco_image_id int, file_name string, width int, height int")
    boxes = spark.createDataFrame([("train", 1, 1, 1, 3, 4, 5, 6, 30)], "split string, coco_image_id int, annotation_id int, category_id int, x int, y int, w int, h int, area int")
    doc = sinks.coco_documents(images, boxes, ["monster"]).first().document
    (tmp_path / "instances_train.json").write_text(doc)
    i, a = files.coco(spark, str(tmp_path / "instances_train.json"))
    assert i.first().file_name == "a.jpg" and list(a.first().bbox) == [3, 4, 5, 6]


def test_catalog_version(spark):
    df = spark.createDataFrame([("x/catalog_1.14.2.bin",), ("x/catalog_1.14.4.bin",), ("x/other",)], "path string")
    assert files.catalog_version(df).first().version == "1.14.4"
    assert files.catalog_version(df.limit(0)).first().version == "unknown"


def test_images_disk_and_index(spark, tmp_path):
    image = pixels.png(np.zeros((3, 4, 4), np.uint8))
    sinks.write_images(spark.createDataFrame([("train", "s0", bytearray(image))], "split string, stem string, image binary"), tmp_path / "images")
    assert (tmp_path / "images/train/s0.jpg").read_bytes() == image
    with pytest.raises(ValueError):
        sinks.mounted("hdfs://host/images")
    sinks.enough_disk(tmp_path, 0)
    with pytest.raises(OSError):
        sinks.enough_disk(tmp_path, 1e12)
    index = spark.createDataFrame([("a.bundle", "k"), ("b.bundle", "l")], "bundle string, asset_key string")
    there = spark.createDataFrame([("x/a.bundle",), ("x/b.bundle",)], "path string")
    assert files.reusable(index, there) and not files.reusable(index, there.limit(1))


@pytest.mark.parametrize("kind", [0, 1, 2])
def test_bundles(kind):
    held = [("a/b", bytes(range(256)) * 30), ("c", b""), ("d", b"xyz" * 7)]
    for form, at_end in ((6, False), (7, True)):
        raw = bundles.packed_bundle(held, kind=kind, block=1000, format=form, at_end=at_end)
        assert [(e.path, data) for e, data in bundles.Bundle(raw).files()] == held
        assert [e[0] for e in bundles.entries(raw)] == ["a/b", "c", "d"]
        for broken in (raw[: len(raw) // 2], b"UnityFS\0", b"nothing", raw[:40]):
            with pytest.raises(bundles.BundleError):
                bundles.Bundle(broken)


def test_lz4_copies():
    """Literals, a copy, a copy that overlaps itself, and lengths that go on in further bytes."""
    assert bundles.lz4_block(bytes([0x40]) + b"abcd", 4) == b"abcd"
    assert bundles.lz4_block(bytes([0x40]) + b"abcd" + bytes([4, 0, 0x10]) + b"!", 9) == b"abcdabcd!"
    assert bundles.lz4_block(bytes([0x1F]) + b"a" + bytes([1, 0, 255, 3, 0x00]), 1 + 4 + 15 + 255 + 3) == b"a" * 278
    for bad in (bytes([0x40]) + b"ab", bytes([0x10]) + b"a" + bytes([2, 0]), bytes([0xF0])):
        with pytest.raises(bundles.BundleError):
            bundles.lz4_block(bad, 99)


def test_encoded_documents_and_atlases():
    tree = {"a": {"b": 1, "c": True, "e": {"f": {}}}, "d": 0.25, "g": "tëxt", "h": (1.0, -2.0), "i": -(2**31)}
    assert documents.Document(documents.encode("root", tree)).tree() == {"root": tree | {"h": {"x": 1.0, "y": -2.0}}}
    a = atlas.read_atlas(atlas.encode(PATHS, [(0, 0, 4, 4), None, (4, 0, 4, 4)], [0, 0, 0], [(0.5, 0.5)] * 3), 3)
    assert [a.find(p) for p in PATHS] == [0, 1, 2] and a.resolve(1) == 0 and a.box[2].tolist() == [4, 0, 4, 4]
