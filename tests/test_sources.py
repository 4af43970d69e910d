"""CSV inputs and their cleaning (FIXTURES.md section 4)."""

from audience_engine.sources import (
    read_notification_artist,
    read_notification_clicks,
    read_plays,
    read_song_artist,
)


def test_malformed_artist_ids_are_dropped(spark, tmp_csv):
    path = tmp_csv("meta", ["S1,10", "S3,abc", "S4,", ",50"])
    rows = read_song_artist(spark, path).collect()
    assert [(r.ArtistId, r.SongId) for r in rows] == [(10, "S1")]


def test_spaces_and_leading_zeros(spark, tmp_csv):
    path = tmp_csv("meta", ["S5, 60", "S6,007"])
    rows = sorted((r.SongId, r.ArtistId) for r in read_song_artist(spark, path).collect())
    assert rows == [("S5", 60), ("S6", 7)]


def test_decimal_ids_keep_their_whole_part(spark, tmp_csv):
    """As the old cast did, whether the column is read as text or inferred."""
    path = tmp_csv("meta", ["S7,12.7", "S8,4"])
    for infer in (False, True):
        assert sorted((r.SongId, r.ArtistId) for r in read_song_artist(spark, path, infer=infer).collect()) == [("S7", 12), ("S8", 4)]


def test_text_that_only_looks_like_a_number_is_dropped(spark, tmp_csv):
    path = tmp_csv("meta", ["S1,1e3", 'S2,"1,234.50"', "S3,.", "S4,12.x", "S5,-3.9", "S6, 8. "])
    assert sorted((r.SongId, r.ArtistId) for r in read_song_artist(spark, path).collect()) == [("S5", -3), ("S6", 8)]


def test_column_order_and_types(spark, tmp_csv):
    df = read_song_artist(spark, tmp_csv("meta", ["S1,10"]))
    assert df.dtypes == [("ArtistId", "bigint"), ("SongId", "string")]


def test_plays_keep_user_and_song_and_drop_nulls(spark, tmp_csv):
    path = tmp_csv("plays", ["u1,1500000000,s1,20200101", "u2,1500000001,,20200101", ",1,s2,20200101"])
    df = read_plays(spark, path)
    assert df.columns == ["UserId", "SongId"]
    assert [tuple(r) for r in df.collect()] == [("u1", "s1")]


def test_plays_ids_stay_text(spark, tmp_csv):
    # inference would make 007 and 7 one user; an explicit string schema does not
    df = read_plays(spark, tmp_csv("plays", ["007,1,s1,d", "7,1,s1,d"]))
    assert sorted(r.UserId for r in df.collect()) == ["007", "7"]


def test_notification_sources(spark, tmp_csv):
    na = read_notification_artist(spark, tmp_csv("na", ["1,10", "x,10", "2,"]))
    assert na.dtypes == [("NotificationId", "bigint"), ("ArtistId", "bigint")]
    assert [tuple(r) for r in na.collect()] == [(1, 10)]
    clicks = read_notification_clicks(spark, tmp_csv("nc", ["1,u1,20200101", "bad,u2,20200101", "3,,20200101"]))
    assert clicks.dtypes == [("NotificationId", "bigint"), ("UserId", "string")]
    assert [tuple(r) for r in clicks.collect()] == [(1, "u1")]


def test_folder_with_several_files(spark, tmp_path):
    d = tmp_path / "many"
    d.mkdir()
    (d / "a.csv").write_text("u1,t,s1,d\n")
    (d / "b.csv").write_text("u2,t,s2,d\n")
    assert read_plays(spark, str(d)).count() == 2
    assert read_plays(spark, [str(d / "a.csv"), str(d / "b.csv")]).count() == 2


def test_inferred_ids_merge_like_the_reference(spark, tmp_csv):
    # with inference the id column is numeric, so 007 and 7 are one user (the reference's behaviour)
    df = read_plays(spark, tmp_csv("plays", ["007,1,s1,d", "7,1,s1,d"]), infer=True)
    assert sorted(r.UserId for r in df.collect()) == ["7", "7"]
    assert df.dtypes == [("UserId", "string"), ("SongId", "string")]


def test_columnar_sources_by_name(spark, tmp_path):
    from audience_engine.sources.tables import plays_from_tables, song_artist_from_tables
    from .conftest import SF_SMALL
    p = str(tmp_path / "plays.parquet")
    plays_from_tables(spark, SF_SMALL).write.parquet(p)
    df = read_plays(spark, p, fmt="parquet")
    assert df.columns == ["UserId", "SongId"] and df.count() == 6000
    m = str(tmp_path / "meta.orc")
    song_artist_from_tables(spark, SF_SMALL).write.orc(m)
    meta = read_song_artist(spark, m, fmt="orc")
    assert meta.dtypes == [("ArtistId", "bigint"), ("SongId", "string")] and meta.count() == 200
