"""Promises of the planners, pixel work and streams."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions import geometry as g
from quarry.operators import coverage, dedup, incremental, pixels, quota, splits
from quarry.streaming import incremental as stream


def test_apportion_meets_the_total(spark):
    rows = [(k, n) for k, n in zip("abcdef", [1, 1, 1, 5, 70, 3], strict=True)]
    for total in (0, 1, 7, 80, 81, 1000):
        got = {r.key: r.quota for r in quota.apportion(spark.createDataFrame(rows, "key string, n long"), total).collect()}
        assert sum(got.values()) == total and all(abs(got[k] - n * total / 81) < 1 for k, n in rows)


def test_apportion_ties_go_to_the_larger_key(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "key string, n long")
    assert {r.key: r.quota for r in quota.apportion(rows, 4).collect()} == {"a": 1, "b": 1, "c": 2}


def test_assigned_is_exact_and_stable(spark):
    rows = spark.range(1000).withColumnRenamed("id", "k")
    quotas = spark.createDataFrame([("x", 100), ("y", 0), ("z", 900)], "key string, quota long")
    order = quota.seeded(3, F.col("k"))
    one = {r.k: r.key for r in quota.assigned(rows, quotas, order).collect()}
    two = {r.k: r.key for r in quota.assigned(rows.repartition(7), quotas, order).collect()}
    assert one == two and collections.Counter(one.values()) == {"x": 100, "z": 900}


def test_least_used_equals_a_heap(spark):
    import heapq

    rng = np.random.default_rng(0)
    counts = {(p, i): int(rng.integers(0, 9)) for p in "ab" for i in range(12)}
    df = spark.createDataFrame([(p, i, n) for (p, i), n in counts.items()], "pool string, item int, n int")
    got = collections.defaultdict(list)
    for r in sorted(quota.least_used(df, ["pool"], 40).collect(), key=lambda r: r.pick):
        got[r.pool].append((r.uses_before, r.item))
    for p in "ab":
        heap = [(n, i) for (q, i), n in counts.items() if q == p]
        heapq.heapify(heap)
        expected = []
        for _ in range(40):
            n, i = heapq.heappop(heap)
            expected.append((n, i))
            heapq.heappush(heap, (n + 1, i))
        assert got[p] == expected


def test_coverage_split(spark):
    rng = np.random.default_rng(1)
    rows = [(i, sorted({int(m) for m in rng.integers(0, 30, 6)})) for i in range(177)]
    got = {r.map_id: r.split for r in splits.coverage_split(spark.createDataFrame(rows, "map_id int, mob_ids array<int>"), 83).collect()}
    assert collections.Counter(got.values()) == {"train": 141, "test": 18, "val": 18}
    train = {m for i, mobs in rows if got[i] == "train" for m in mobs}
    assert train == {m for _, mobs in rows for m in mobs}


def test_greedy_gate(spark):
    pairs = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (1, 5), (4, 5)], "i int, j int")
    df = spark.range(1, 7).withColumnRenamed("id", "ordinal")
    classes = df.select(F.col("ordinal").alias("sig"), F.col("ordinal").alias("first"))
    more = df.unionByName(spark.range(7, 9).withColumnRenamed("id", "ordinal"))  # rows with a signature that came before
    assert {r.ordinal for r in dedup.greedy_gate(more, classes, pairs).collect() if r.accepted} == {1, 3, 6}


def test_hamming_pairs_by_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(-(2**63), 2**63 - 1, 60)
    sigs = [int(b) ^ (0 if f == 0 else sum(1 << int(x) for x in rng.choice(62, f, replace=False))) for b in base for f in (0, 1, 2, 3, 0)]
    df = spark.createDataFrame(list(enumerate(sigs)), "ordinal long, sig long")
    classes = dedup.signature_classes(df)
    first = {}
    for i, sig in enumerate(sigs):
        first.setdefault(sig, i)
    assert {r.sig: r.first for r in classes.collect()} == first
    mask = 2**64 - 1
    own = sorted(first.values())
    for most in (0, 1, 2, 4):
        got = {(r.i, r.j): r.distance for r in dedup.hamming_pairs(classes, most).collect()}
        assert got == {(i, j): d for i in own for j in own if i < j and (d := ((sigs[i] & mask) ^ (sigs[j] & mask)).bit_count()) <= most}
    ratio = dedup.earlier_match_ratio(df, classes, dedup.hamming_pairs(classes)).first()
    assert ratio.near_rows == sum(any(((sigs[i] & mask) ^ (sigs[j] & mask)).bit_count() <= 2 for i in range(j)) for j in range(len(sigs)))
    accepted = []
    for j in range(len(sigs)):
        if not any(((sigs[i] & mask) ^ (sigs[j] & mask)).bit_count() <= 2 for i in accepted):
            accepted.append(j)
    assert sorted(r.ordinal for r in dedup.greedy_gate(df, classes, dedup.hamming_pairs(classes)).collect() if r.accepted) == accepted


def test_running_sums_and_places(spark):
    import hashlib

    rng = np.random.default_rng(6)
    order = rng.permutation(5000)[:900].tolist()
    rows = [(int(o), "ab"[int(rng.random() < 0.2)], int(rng.integers(0, 9))) for o in order]
    got = {r.o: (r.before, r.total) for r in quota.running(spark.createDataFrame(rows, "o long, k string, n int"), "k", "o", {"before": F.lit(1), "total": F.col("n")}).collect()}
    for o, k, _ in rows:
        own = [x for x in rows if x[1] == k and x[0] < o]
        assert got[o] == (len(own), sum(x[2] for x in own))
    places = {r.o: r.place for r in quota.hash_places(spark.createDataFrame(rows, "o long, k string, n int"), quota.seeded(1, F.col("o")), ("n",)).collect()}
    wanted = sorted(rows, key=lambda r: (r[2], hashlib.md5(f"1:{r[0]}".encode()).hexdigest()))
    assert [places[r[0]] for r in wanted] == list(range(len(rows)))
    assert quota.running(spark.createDataFrame([], "o long, k string"), "k", "o", {"before": F.lit(1)}).collect() == []


def test_running_sums_of_rows_in_any_order(spark):
    """Approximate percentiles depend on the order of the rows, which is another at every reading here; sums do not."""

    def stirred(batches):
        for pdf in batches:
            yield pdf.sample(frac=1)

    kept = {c: spark.conf.get(c) for c in ("spark.sql.exchange.reuse", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    spark.conf.set("spark.sql.exchange.reuse", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "200000")
    try:
        rows = spark.range(0, 400000, 1, 4).selectExpr("id * 7919 % 400009 as o", "'a' as k").mapInPandas(stirred, "o long, k string")
        got = quota.running(rows, "k", "o", {"before": F.lit(1)}).agg(F.count("*").alias("n"), F.count_distinct("before").alias("places"), F.max("before").alias("last")).first()
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
    assert (got.n, got.places, got.last) == (400000, 400000, 399999)


def test_nearest_rank(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "v double")
    assert df.agg(coverage.nearest_rank(F.col("v"), 0.5).alias("p")).first().p == 3.0
    assert df.limit(0).agg(coverage.nearest_rank(F.col("v"), 0.5).alias("p")).first().p == 0


def test_platform_y_rounds_half_to_even(spark):
    df = spark.createDataFrame([(0, 0, 2, 1, 1), (0, 0, 2, 3, 1), (5, 7, 5, 2, 5)], "x1 int, y1 int, x2 int, y2 int, x int")
    assert [r.y for r in df.select(g.platform_y(F.col("x")).alias("y")).collect()] == [0, 2, 7]


def test_empty_inputs(spark):
    boxes = spark.createDataFrame([], "image_id long, idx int, x int, y int, w int, h int, foothold_id int")
    from quarry.operators import layout

    assert layout.layout_measures(boxes).collect() == [] and layout.box_pairs(boxes).collect() == []
    assert dedup.hamming_pairs(dedup.signature_classes(spark.createDataFrame([], "ordinal long, sig long"))).collect() == []


def test_guard():
    incremental.guard("a", None)
    incremental.guard("a", "a")
    with pytest.raises(ValueError):
        incremental.guard("a", "b")


def solid(h, w, colour=(200, 10, 10, 255)):
    return np.full((h, w, 4), colour, np.uint8)


def test_paste_clips_and_blends():
    canvas = solid(4, 6, (0, 0, 0, 255))
    pixels.paste(canvas, solid(3, 3), -1, -1)
    assert canvas[0, 0].tolist() == [200, 10, 10, 255] and canvas[2, 2].tolist() == [0, 0, 0, 255]
    pixels.paste(canvas, solid(1, 1, (255, 255, 255, 0)), 0, 0)
    assert canvas[0, 0].tolist() == [200, 10, 10, 255]
    pixels.paste(canvas, solid(2, 2), 50, 50)
    half = np.concatenate([solid(1, 1, (255, 0, 0, 255)), solid(1, 1, (0, 0, 255, 255))], axis=1)
    pixels.paste(canvas, half, 4, 3, flip=True)
    assert canvas[3, 4].tolist() == [0, 0, 255, 255]


def test_alpha_box_and_digest():
    image = np.zeros((6, 8, 4), np.uint8)
    assert pixels.alpha_box(image) is None
    image[2:4, 3:7] = (255, 0, 0, 255)
    assert pixels.alpha_box(image) == (3, 2, 7, 4)
    moved = np.zeros((9, 9, 4), np.uint8)
    moved[5:7, 1:5] = (255, 0, 0, 255)
    assert pixels.digest(image) == pixels.digest(moved) and pixels.digest(image)[1:] == (4, 2, 8, 1.0)


def test_visibility():
    alpha = np.full((4, 4), 255, np.uint8)
    front = np.zeros((10, 10), np.uint8)
    assert pixels.visibility(alpha, 3, 3, front) == (1.0, 1.0, 0.0)
    assert pixels.visibility(alpha, -2, 0, front)[0] == 0.5
    front[:, :5] = 255
    assert pixels.visibility(alpha, 3, 3, front) == (1.0, 0.5, 0.5)
    assert pixels.visibility(alpha, 50, 50, front) == (0.0, 0.0, 0.0)


def test_perceptual_hash_is_robust():
    rng = np.random.default_rng(0)
    image = np.kron(rng.integers(0, 255, (8, 16, 3)), np.ones((20, 20, 1))).astype(np.uint8)
    image = np.concatenate([image, np.full((*image.shape[:2], 1), 255, np.uint8)], axis=2)
    noisy = image.copy()
    noisy[..., :3] = np.clip(noisy[..., :3].astype(int) + rng.integers(-2, 3, noisy[..., :3].shape), 0, 255)
    other = image[::-1]
    distance = lambda a, b: (pixels.perceptual_hash(a) ^ pixels.perceptual_hash(b)).bit_count()
    assert distance(image, noisy) <= 2 < distance(image, other)


def part(path, z, h, w, colour, anchors, origin=(0, 0)):
    return {"path": path, "z": z, "image": solid(h, w, colour), "origin": origin, "anchors": anchors}


def test_compose():
    body = part("x/body", "body", 8, 10, (255, 0, 0, 255), {"neck": (4, 0)})
    head = part("x/head", "head", 8, 8, (0, 0, 255, 255), {"neck": (4, 8)})
    loose = part("x/cap", "cap", 2, 2, (0, 255, 0, 255), {"brow": (0, 0)})
    got = pixels.compose([body, head], {"x/body", "x/head"})
    assert got["image"].shape == (16, 10, 4) and {tuple(c) for c in got["image"].reshape(-1, 4)} >= {(255, 0, 0, 255), (0, 0, 255, 255)}
    assert pixels.compose([body], {"x/body", "x/head"}) is None
    assert pixels.compose([body, loose], {"x/cap"}) is None and pixels.compose([body, loose]) is not None
    assert pixels.compose([]) is None


def test_render_scenes(spark):
    sprites = [("red", 10, 12, bytearray(solid(10, 12).tobytes())), ("wall", 30, 6, bytearray(solid(30, 6, (0, 0, 0, 255)).tobytes()))]
    scenes = [(1, 0, "target", "red", 5, 5, False), (1, 1, "front", "wall", 11, 0, False), (2, 0, "target", "red", -9, 0, True), (2, 0, "target", "red", 30, 20, True)]
    out = pixels.render_scenes(
        spark.createDataFrame(scenes, "scene int, layer int, kind string, path string, x int, y int, flip boolean"),
        spark.createDataFrame(sprites, "path string, height int, width int, pixels binary"), 64, 48,
    ).collect()
    got = {r.scene: r for r in out}
    assert got[1].image[:3] == b"\xff\xd8\xff" and got[1].labels[0].visible_fraction == 0.5 and got[1].labels[0].occlusion_fraction == 0.5
    assert [(x.x, x.y) for x in got[2].labels] == [(30, 20)]


def many_scenes(spark, n):
    rows = [(i, 0, ("target", "hidden")[i % 2], f"s{i % 5}", i % 50 - 6, i % 40 - 4, i % 3 == 0) for i in range(n)] + [(i, 1, "front", "wall", i % 64, 0, False) for i in range(n)]
    sprites = [(f"s{k}", 6 + k, 9 + k, bytearray(solid(6 + k, 9 + k).tobytes())) for k in range(5)] + [("wall", 30, 6, bytearray(solid(30, 6, (0, 0, 0, 255)).tobytes()))]
    return spark.createDataFrame(rows, "scene int, layer int, kind string, path string, x int, y int, flip boolean"), spark.createDataFrame(sprites, "path string, height int, width int, pixels binary")


def test_scenes_without_images(spark, monkeypatch):
    """Who reads no image pays for none; a sprite in every scene is dealt to many tasks, and scenes may be cut by Arrow batches."""
    monkeypatch.setattr(pixels, "USES", 20)
    rows, sprites = many_scenes(spark, 150)
    whole = {r.scene: (r.labels, r.hidden) for r in pixels.render_scenes(rows, sprites, 64, 48).collect()}
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        plain = pixels.render_scenes(rows, sprites, 64, 48, images=False)
        assert plain.columns == ["scene", "labels", "hidden"]
        got = plain.collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert len(got) == 150 and {r.scene: (r.labels, r.hidden) for r in got} == whole
    for scene, (labels, hidden) in whole.items():
        k, x, y = scene % 5, scene % 50 - 6, scene % 40 - 4
        x0, y0, x1, y1 = max(0, x), max(0, y), min(64, x + 9 + k), min(48, y + 6 + k)
        inside, behind = (x1 - x0) * (y1 - y0), max(0, min(x1, scene % 64 + 6) - max(x0, scene % 64)) * max(0, min(y1, 30) - y0)
        for r in [*labels, *hidden]:
            assert (r.path, r.x, r.y, r.w, r.h, r.occlusion_fraction) == (f"s{k}", x0, y0, x1 - x0, y1 - y0, round(behind / inside, 4))
        assert scene % 2 == 0 or len(hidden) == 1


def test_hidden_objects_and_unlabelled_ones(spark):
    sprites = [("red", 10, 12, bytearray(solid(10, 12).tobytes())), ("tile", 4, 4, bytearray(solid(4, 4, (0, 0, 255, 255)).tobytes()))]
    scenes = [(1, 0, "target", "red", 5, 5, False, 255, 0), (1, 0, "hidden", "red", 11, 5, False, 255, 0), (1, 1, "hidden", "red", 11, 10, False, 255, 0), (1, 0, "npc", "red", 40, 5, False, 255, 0), (1, 0, "back", "tile", 2, 40, False, 128, 6)]
    out = pixels.render_scenes(
        spark.createDataFrame(scenes, "scene int, layer int, kind string, path string, x int, y int, flip boolean, alpha int, step_x int"),
        spark.createDataFrame(sprites, "path string, height int, width int, pixels binary"), 64, 48, quality=None,
    ).first()
    assert [(x.x, x.visible_fraction) for x in out.labels] == [(5, 0.5)]
    first, second = sorted(out.hidden, key=lambda r: r.y)
    assert (first.visible_fraction, second.visible_fraction) == (0.5, 1.0) and first.max_target_iou == round(60 / 180, 4)
    image = pixels.read_png(out.image)
    assert image[6, 45].tolist() == [200, 10, 10, 255] and all((image[41, x, 2] > 245) == ((x - 2) % 6 < 4) for x in range(64))


def test_jpegs_of_one_call():
    """Files of one call are those of single calls: codes, padding and equal blocks of one image touch no other."""
    from quarry.operators.jpeg import jpeg, jpegs

    rng = np.random.default_rng(5)
    images = np.stack([*(np.full((19, 27, 4), 200, np.uint8) for _ in range(3)), *rng.integers(0, 256, (3, 19, 27, 4)).astype(np.uint8)])
    images[1, 3:9, 4:20] = 17
    for quality in (50, 92, 100):
        assert jpegs(images, quality) == [jpeg(i, quality) for i in images]


def test_jpeg_opens_elsewhere(spark):
    """The platform's own decoder reads the files, and the pixels are near."""
    from quarry.operators.jpeg import jpeg

    rng = np.random.default_rng(3)
    y, x = np.mgrid[0:53, 0:70]
    smooth = np.stack([x * 3 % 256, y * 4, 255 - x * 2], axis=2).astype(np.uint8)
    noise = np.kron(rng.integers(0, 256, (7, 9, 3)), np.ones((8, 8, 1))).astype(np.uint8)
    jvm = spark._jvm
    for image, quality, most in ((smooth, 95, 6), (noise, 95, 8), (np.full((8, 8, 3), 77, np.uint8), 90, 2), (np.zeros((1, 1, 4), np.uint8), 50, 3), (rng.integers(0, 256, (64, 64, 3)).astype(np.uint8), 100, 3)):
        data = jpeg(image, quality)
        stream = jvm.java.io.ByteArrayInputStream(bytearray(data))
        got = jvm.javax.imageio.ImageIO.read(stream)
        assert (got.getWidth(), got.getHeight()) == (image.shape[1], image.shape[0])
        flat = got.getRGB(0, 0, image.shape[1], image.shape[0], None, 0, image.shape[1])
        pixel = np.array(list(flat), np.int64)
        rgb = np.stack([pixel >> 16 & 255, pixel >> 8 & 255, pixel & 255], axis=1).reshape(*image.shape[:2], 3)
        assert np.abs(rgb - image[..., :3]).mean() <= most


def test_whole_figures_and_sheets():
    body = part("x/body", "body", 20, 10, (255, 0, 0, 255), {"neck": (4, 0)})
    head = part("x/head", "head", 20, 8, (0, 0, 255, 255), {"neck": (4, 20)})
    far = part("x/head", "head", 20, 8, (0, 0, 255, 255), {"neck": (4, 24)})
    need = {"body": ("body",), "head": ("head", "face")}
    assert pixels.whole_figure([body, head], need)["image"].shape == (40, 10, 4)
    assert pixels.whole_figure([body, far], need) is None and pixels.whole_figure([body], need) is None
    text = pixels.number_sprite("1024", scale=2)
    assert text.shape == (14, 34, 4) and (text[..., 3] > 0).any() and not text[0, 0, 3]
    page = pixels.sheet([solid(4, 4), solid(20, 20)], 2, (10, 8))
    assert page.shape == (8, 20, 4) and page[4, 5].tolist() == [200, 10, 10, 255] and page[0, 0].tolist() == [255] * 4 and page[0, 10].tolist() == [200, 10, 10, 255]


def test_shared_folder_is_needed_off_one_machine(monkeypatch):
    from quarry.operators import store

    class Session:
        class conf:
            get = staticmethod(lambda name, default: default)

        class sparkContext:
            master, applicationId = "spark://host:7077", "a"

    with pytest.raises(RuntimeError):
        store.shared_dir(Session)
    Session.sparkContext.master = "local[4]"
    assert store.shared_dir(Session) == store.shared_dir(Session)


def test_digest_frames(spark):
    rows = [("a", 10, 12, bytearray(solid(10, 12).tobytes())), ("b", 2, 2, bytearray(16))]
    got = {r.path: r for r in pixels.digest_frames(spark.createDataFrame(rows, "path string, height int, width int, pixels binary")).collect()}
    assert got["a"].alpha_pixels == 120 and len(got["a"].phash) == 16 and got["b"].digest is None


def test_streams(spark, tmp_path):
    schema = "id long, sha string, ts timestamp"
    rows = [(1, "a", "2024-01-01 00:00:00"), (2, "a", "2024-01-01 00:01:00"), (3, "b", "2024-01-01 00:02:00")]
    df = spark.createDataFrame(rows, "id long, sha string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    for i in range(2):
        df.write.mode("append").parquet(str(tmp_path / "in"))
        stream.commit_new(stream.source(spark, str(tmp_path / "in"), schema), str(tmp_path / "out"), "id", str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    seen = stream.first_seen(stream.source(spark, str(tmp_path / "in"), schema), "sha", "ts", "1 hour")
    q = seen.writeStream.format("memory").queryName("seen").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.sha for r in spark.table("seen").collect()) == ["a", "b"]
    counts = stream.windowed_counts(stream.source(spark, str(tmp_path / "in"), schema), "ts", "10 minutes", "5 minutes", ["sha"])
    q = counts.writeStream.format("memory").outputMode("complete").queryName("counts").option("checkpointLocation", str(tmp_path / "c3")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.sha: r.n for r in spark.table("counts").collect()} == {"a": 4, "b": 2}


CONFIG = {
    "seed": 7, "splits": {"train": 160, "val": 20, "test": 20}, "box_quotas": {0: 80, 1: 40, 2: 30, 3: 30, 8: 20}, "player_quotas": {0: 120, 1: 60, 2: 20},
    "loot_count_quotas": {1: 50, 2: 40, 5: 30}, "loot_layout_quotas": {"scattered": 60, "dense_stack": 40}, "multi_platform_fraction": 0.5,
    "target_layout_weights": {"1-3": {"distributed": 0.5, "overlap": 0.5}, "4-8": {"severe_overlap": 1.0}},
    "item_coverage": True, "item_visual_count": 10, "minimum_item_val_uses": 4, "minimum_item_test_uses": 4,
    "scenarios": {
        "negative_loot": {"count": 50, "positive": False, "min_players": 0, "max_players": 0, "min_loot": 1, "max_loot": 5},
        "player_loot": {"count": 30, "positive": False, "min_players": 1, "max_players": 2, "min_loot": 1, "max_loot": 2},
        "monster": {"count": 70, "positive": True, "min_players": 0, "max_players": 0, "min_instances": 1, "max_instances": 8},
        "monster_player_loot": {"count": 50, "positive": True, "min_players": 1, "max_players": 2, "min_loot": 1, "max_loot": 5, "min_instances": 1, "max_instances": 3},
    },
}


@pytest.mark.parametrize("limit", [None, 60, 37])
def test_schedule_meets_all_quotas(spark, limit):
    from quarry.operators import schedule as s

    rows = s.schedule(spark, CONFIG, limit).collect()
    total = limit or 200
    count = lambda f: dict(collections.Counter(f(r) for r in rows))
    some = lambda quotas: {k: n for k, n in s.scaled(quotas, total).items() if n}
    assert len(rows) == total and count(lambda r: r.split) == some(CONFIG["splits"]) and count(lambda r: r.target_count) == some(CONFIG["box_quotas"])
    for r in rows:
        spec = CONFIG["scenarios"][r.scenario]
        assert (r.target_count > 0) == spec["positive"] and spec["min_players"] <= r.player_count <= spec["max_players"]
        assert r.loot_count == 0 if "max_loot" not in spec else spec["min_loot"] <= r.loot_count <= spec["max_loot"]
        assert (r.loot_layout == "none") == (r.loot_count == 0) and (r.target_layout == "none") == (r.target_count == 0)
    assert sorted(r.ordinal for r in rows) == list(range(total)) and len({(r.split, r.split_index) for r in rows}) == total
    if limit is None:
        for split in ("val", "test"):
            assert sum(r.loot_count for r in rows if r.split == split) >= 40
        assert count(lambda r: r.scenario) == {k: v["count"] for k, v in CONFIG["scenarios"].items()}
    assert s.plan(CONFIG, limit) == s.plan(CONFIG, limit)


def test_schedule_of_many_blocks(spark, monkeypatch):
    """Tasks make the rows of plan(), block by block, with running indexes and swaps across blocks; every order is a permutation."""
    from quarry.operators import schedule as s

    for n in (1, 2, 3, 64, 1000):
        for name in ("a", "b"):
            assert sorted(s.permuted(7, name, np.arange(n), n).tolist()) == list(range(n))
    whole = s.plan(CONFIG)
    monkeypatch.setattr(s, "ROWS", 13)
    monkeypatch.setattr(s, "BLOCKS", 6)
    assert s.Layout(CONFIG).blocks > 1
    monkeypatch.setattr(s.Layout, "chunks", lambda self, block: iter([np.arange(block * self.block, min(self.total, (block + 1) * self.block))]))
    assert s.plan(CONFIG) == whole
    of = collections.defaultdict(list)
    for r in whole:
        of[r[1]].append(r[2])
    assert all(v == list(range(len(v))) for v in of.values())


def test_schedule_is_made_by_tasks(spark):
    from quarry.operators import schedule as s

    big = CONFIG | {k: {v: n * 1000 for v, n in CONFIG[k].items()} for k in ("splits", "box_quotas", "player_quotas", "loot_count_quotas")}
    big |= {"item_visual_count": 10000, "scenarios": {k: v | {"count": v["count"] * 1000} for k, v in CONFIG["scenarios"].items()}}
    rows = s.schedule(spark, big)
    assert "LocalTableScan" not in rows._jdf.queryExecution().executedPlan().toString() and "LogicalRDD" not in rows._jdf.queryExecution().analyzed().toString()
    count = lambda c: {r[0]: r[1] for r in rows.groupBy(c).count().collect()}
    assert count("split") == big["splits"] and count("target_count") == big["box_quotas"] and count("scenario") == {k: v["count"] for k, v in big["scenarios"].items()}
    loot = {r[0]: r[1] for r in rows.groupBy("split").agg(F.sum("loot_count")).collect()}
    assert loot["val"] >= 40000 and loot["test"] >= 40000
    assert rows.agg(F.count_distinct("split", "split_index")).first()[0] == 200000 and sorted(map(tuple, rows.where("ordinal < 70000").collect())) == s.plan(big)[:70000]


def test_schedule_refuses_what_cannot_be(spark):
    from quarry.operators import schedule as s

    bad = CONFIG | {"box_quotas": {0: 80, 1: 40, 2: 30, 3: 30, 9: 20}}
    with pytest.raises(ValueError):
        s.plan(bad)
    assert set(s.plan_sha256(s.plan(CONFIG), CONFIG)) == {"schedule_sha256", "config_sha256"}


def test_placement(spark):
    from quarry.operators import maps, placement

    footholds = spark.createDataFrame([(1, 1, 0, 100, 600, 100), (1, 2, 200, 50, 700, 60), (1, 3, 5, 0, 5, 90)], "map_id int, foothold_id int, x1 int, y1 int, x2 int, y2 int")
    rows = [(i, 1, 100 + i, m, 4, 40) for i, m in enumerate(["natural", "distributed", "clustered", "overlap", "multi_platform"] * 4)]
    samples = spark.createDataFrame(rows, "sample long, map_id int, seed long, mode string, n int, width int")
    placed = placement.place_actors(samples, footholds).cache()
    got = collections.defaultdict(list)
    for r in placed.collect():
        got[r.sample].append(r)
        line = {1: 100, 2: 50 + 10 * (r.x - 200) / 500}[r.foothold_id]
        assert abs(r.y - line) <= 0.5
    for s in rows:
        own, step = got[s[0]], int(40 * placement.SPACING[s[3]])
        assert len(own) == 4 and all(abs(a.x - b.x) >= step or a.foothold_id != b.foothold_id for a in own for b in own if a.slot < b.slot)
        assert s[3] != "multi_platform" or len({r.foothold_id for r in own}) == 2
    again = placement.place_actors(samples.repartition(5), footholds)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, placed.collect()))
    cameras = placement.camera(placed.join(samples.select("sample", "map_id"), "sample"), maps.camera_bounds(footholds), 3).collect()
    assert len(cameras) == 20 and all(-100 <= c.camera_x <= max(-100, 800 - 1280) for c in cameras)
    loot = samples.select("sample", "map_id", "seed", F.lit("dense_stack").alias("layout"), F.lit(15).alias("n"))
    piles = placement.place_loot(loot, footholds.selectExpr("map_id", "x1 + 20 as x", "y1 as y", "foothold_id").where("foothold_id < 3"), footholds).collect()
    assert len({(p.sample, p.x, p.y) for p in piles}) == len(piles) == 20 * 15
    for p in piles:
        assert {1: 0, 2: 200}[p.foothold_id] <= p.x <= {1: 600, 2: 700}[p.foothold_id] and abs(p.y - {1: 100, 2: 50 + 10 * (p.x - 200) / 500}[p.foothold_id]) <= 0.5


def test_first_accepted(spark):
    from quarry.operators import placement

    rows = [(1, 1, 2, 3, 0, 0, 0.9, 1.0, 1.0), (1, 2, 3, 3, 0, 0, 0.9, 1.0, 1.0), (1, 3, 3, 3, 0, 0, 0.9, 1.0, 1.0), (2, 1, 3, 3, 0, 1, 0.9, 1.0, 1.0), (3, 1, 2, 2, 0, 0, 0.3, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "sample int, attempt int, placed int, wanted int, outside int, crowded int, span double, least_clip double, least_visible double")
    judged = placement.accepted_scenes(df)
    assert [r.reason for r in judged.orderBy("sample", "attempt").collect()] == ["count", "accepted", "accepted", "crowded", "narrow"]
    assert [(r.sample, r.attempt) for r in placement.first_accepted(judged).collect()] == [(1, 2)]


def test_links_and_catalogues(spark):
    from quarry.operators import frames as f

    rows = [("a", "x/0", None), ("a", "x/1", "0"), ("a", "y/0", "../x/1"), ("a", "z", "z2"), ("a", "z2", "z"), ("a", "w", "nowhere")]
    got = {r.path: r.target for r in f.resolved_links(spark.createDataFrame(rows, "asset string, path string, link string")).collect()}
    assert got == {"x/0": "x/0", "x/1": "x/0", "y/0": "x/0", "z": None, "z2": None, "w": None}
    pets = spark.createDataFrame([("p1", "d1", 1), ("p2", "d1", 1), ("p2", "d2", 2), ("p3", "d1", 1)], "pet string, digest string, no int")
    assert {r.pet: r.digest for r in f.first_unseen(pets, "pet", "digest", ["no"]).collect()} == {"p1": "d1", "p2": "d2"}


def test_first_unseen_of_many_frames(spark):
    """More than a million frames with few different pictures; the second pet's first picture is taken."""
    from quarry.operators import frames as f

    rows = spark.range(1_200_000).selectExpr("concat('p', id % 3) as pet", "concat('d', id % 12 div 3) as digest", "id as no")
    assert {r.pet: r.digest for r in f.first_unseen(rows, "pet", "digest", ["no"]).collect()} == {"p0": "d0", "p1": "d1", "p2": "d2"}
    none = spark.createDataFrame([(None, None, 1), (None, "d1", 2), ("a", "d1", 1), ("a", None, 0), ("b", "d1", 1)], "pet string, digest string, no int")
    assert {r.pet: r.digest for r in f.first_unseen(none, "pet", "digest", ["no"]).collect()} == {None: None, "a": "d1"}


def test_atlas_assembly(spark):
    from quarry.operators import frames as f

    nodes = spark.createDataFrame([("m.sheet", "stand/0", "k", 9, 9, "body"), ("m.sheet", "x", "none", 1, 1, None)], "asset string, path string, key string, origin_x int, origin_y int, z string")
    atlas = spark.createDataFrame([("m.sheet", "k", 1, 0, 0, 10, 8, 0.25, 0.75)], "asset string, name string, page int, x int, y int, w int, h int, pivot_x float, pivot_y float")
    got = f.logical_frames(nodes, atlas).collect()
    assert [(r.path, r.origin_x, r.origin_y) for r in got] == [("stand/0", 2, 2)]
    assets = spark.createDataFrame([("m_0.png",)], "asset_key string")
    found, missing = f.atlas_pages(assets, atlas.withColumnRenamed("name", "n").select("asset", "page"))
    assert [r.page for r in found.collect()] == [0] and [r.asset_key for r in missing.collect()] == ["m_1.png"]


def test_index_keeps_going(spark):
    from quarry.operators import frames as f

    def read(content):
        if content == b"bad":
            raise ValueError("broken")
        return [("a\\b", 7, "Texture")]

    df = spark.createDataFrame([("one", bytearray(b"ok")), ("two", bytearray(b"bad"))], "path string, content binary")
    assets, failures = f.index_assets(df, read)
    assert [tuple(r) for r in assets.collect()] == [("one", "a/b", 7, "Texture")] and failures.first().error == "ValueError: broken"


def test_validation_report(spark):
    from quarry.operators import report

    rows = spark.createDataFrame([("A", str(i), "") for i in range(150)] + [("B", "x", "")], "rule_id string, key string, detail string")
    got = {r.rule_id: (r.n, len(r["keys"])) for r in report.validation_report(rows).collect()}
    assert got == {"A": (150, 100), "B": (1, 1)}


def test_visuals_overlays_and_thinning(spark):
    from quarry.operators import placement

    footholds = spark.createDataFrame([(1, 1, 0, 50, 400, 52), (1, 2, 0, 0, 300, 90)], "map_id int, foothold_id int, x1 int, y1 int, x2 int, y2 int")
    samples = spark.createDataFrame([(i, 1) for i in range(30)], "sample long, map_id int")
    taken = spark.createDataFrame([(i, 200) for i in range(30)] + [(0, 10), (0, 390)], "sample long, x int")
    got = {r.sample: r for r in placement.place_visual(samples, footholds, taken, 48, 5).collect()}
    assert set(got) == set(range(1, 30)) and {r.x for r in got.values()} == {10, 390} and {r.foothold_id for r in got.values()} == {1}
    df = spark.createDataFrame([("negative_pet", [], 0, False), ("x", ["skill"], 3, True)], "scene string, overlays array<string>, loot int, death boolean")
    kinds = df.select(placement.overlay_kinds(F.col("scene"), F.col("overlays"), F.col("loot"), F.col("death")).alias("k")).collect()
    assert [r.k for r in kinds] == [["pet"], ["death", "loot", "skill"]]
    rng = np.random.default_rng(3)
    rows = [(m, i, int(rng.integers(0, 500)), int(rng.integers(0, 100))) for m in range(3) for i in range(60)]
    kept = placement.thinned(spark.createDataFrame(rows, "map_id int, spawn_id int, x int, y int")).collect()
    near = lambda a, b: a.map_id == b.map_id and abs(a.x - b.x) < 40 and abs(a.y - b.y) < 30
    assert not any(near(a, b) for a in kept for b in kept if a.spawn_id < b.spawn_id) and {(r.map_id, r.spawn_id) for r in kept} >= {(m, 0) for m in range(3)}


def test_parallax_and_clamp(spark):
    df = spark.createDataFrame([(0, 0, 900), (925, -100, 900)], "x int, rx int, camera int")
    assert [r.b for r in df.select(g.parallax_base(F.col("x"), F.col("camera"), F.col("rx"), 100, F.lit(2)).alias("b")).collect()] == [48, 23]
    df = spark.createDataFrame([(-5, 10), (1275, 10), (7, 2000)], "x int, w int")
    assert [r.c for r in df.select(g.clamped(F.col("x"), F.col("w")).alias("c")).collect()] == [0, 1270, 0]
    left, top = g.frame_box(F.lit(0), F.lit(0), F.lit(True))
    assert tuple(spark.createDataFrame([(25, 20, 10, 2, 5)], "world_x int, world_y int, width int, origin_x int, origin_y int").select(left, top).first()) == (17, 15)


def test_png_round_trip():
    import struct
    import zlib

    rng = np.random.default_rng(0)
    image = rng.integers(0, 255, (9, 7, 4)).astype(np.uint8)
    assert (pixels.read_png(pixels.png(image)) == image).all()
    # one row with each filter, built by hand
    plain = rng.integers(0, 255, (5, 6, 3)).astype(np.int64)
    raw, above = b"", np.zeros((6, 3), np.int64)
    for kind, row in enumerate(plain):
        left = np.concatenate([np.zeros((1, 3), np.int64), row[:-1]])
        corner = np.concatenate([np.zeros((1, 3), np.int64), above[:-1]])
        p = left + above - corner
        a, b, c = abs(p - left), abs(p - above), abs(p - corner)
        paeth = np.where((a <= b) & (a <= c), left, np.where(b <= c, above, corner))
        guess = [0 * row, left, above, (left + above) // 2, paeth][kind]
        raw += bytes([kind]) + ((row - guess) & 255).astype(np.uint8).tobytes()
        above = row
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    data = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 6, 5, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    assert (pixels.read_png(data)[..., :3] == plain).all()
    with pytest.raises(ValueError):
        pixels.read_png(b"GIF89a")


def test_edge_camera(spark):
    from quarry.operators import placement

    actors = spark.createDataFrame([(s, 1, i, 1000 + 100 * i, 300, 40, 50) for s in range(40) for i in range(4)], "sample long, map_id int, slot int, x int, y int, w int, h int")
    cameras = spark.createDataFrame([(s, 600, 200) for s in range(40)], "sample long, camera_x int, camera_y int")
    bounds = spark.createDataFrame([(1, -5000, 5000, -5000, 5000)], "map_id int, left_ int, right_ int, top_ int, bottom_ int")
    for r in placement.edge_camera(actors, cameras, bounds, 3).collect():
        seen = {"left": (1040 - r.camera_x) / 40, "right": (r.camera_x + 1280 - 1300) / 40, "top": (350 - r.camera_y) / 50, "bottom": (r.camera_y + 224 - 300) / 50}[r.side]
        assert 0.27 <= seen <= 0.93
