"""Domain operators against hand-typed rows shaped like the reference goldens."""

from pyspark.sql import functions as F

from riffle.operators import fish, habitat, scoring
from riffle.functions.text import file_name, text_len


def test_priority_rules(spark):
    df = spark.createDataFrame(
        [("High", "Barrier"), ("High", "Potential"), ("Medium", "Potential"), ("Low", "Potential"),
         ("High", "Passable"), (None, "Barrier"), ("Medium", None)], "habitat_value string, barrier_result string")
    got = [r[0] for r in scoring.site_priority(df).select("priority_phase1").collect()]
    assert got == ["high", "mod", "low", "low", None, None, None]


def test_structure_size_matches_golden_rows_with_base_span_10(spark):
    df = spark.createDataFrame(
        [("Barrier", 3.4, 3.0), ("Barrier", 5.3, 5.5), ("Passable", 5.6, 3.0), ("Barrier", 5.6, 1.0),
         ("Barrier", 2.3, 0.45), ("Barrier", 1.4, 1.5), ("Unknown", None, None), ("Potential", 3.0, 6.0)],
        "barrier_result string, downstream_channel_width_meters double, fill_depth_meters double")
    out = scoring.structure_size(df, base_span=10.0).select("crossing_fix", "span_input").collect()
    assert [r[1] for r in out] == [10.0, 17.5, None, 10.0, 10.0, 3.0, None, 4.5]
    assert out[5][0] == scoring.STREAMBED_SIM and out[2][0] is None and out[7][0] == scoring.STREAMBED_SIM


def test_cost_and_cost_benefit(spark):
    df = spark.createDataFrame(
        [(1, "fsr", "rough", scoring.OPEN_BOTTOM, 15.0, 2000.0, 4.0),
         (2, "local", "paved", scoring.STREAMBED_SIM, 3.0, 500.0, 2.0),
         (3, "nowhere", "rough", scoring.OPEN_BOTTOM, 15.0, 100.0, 2.0),
         (4, "fsr", "rough", scoring.OPEN_BOTTOM, 15.0, 100.0, 2.0)],
        "site_id long, my_road_class string, my_road_surface string, crossing_fix string, span_input double, "
        "habitat_net_m double, downstream_channel_width_meters double")
    over = spark.createDataFrame([(4, 0.0)], "site_id long, cost double")
    est = scoring.cost(df, scoring.road_rates(spark), over)
    cb = scoring.cost_benefit(est, lengths={"net": "habitat_net_m"}).orderBy("site_id")
    got = [(r.cost_est_1000s, r.cost_net, r.cost_area_net) for r in cb.collect()]
    assert got[0] == (450.0, 4.4, 8.9)      # 30 $K/m × 15 m; 2000/450; 2000·4·0.5/450
    assert got[1] == (400.0, 1.2, 1.2)      # lump sum for a simulation; 1.25 rounds to even
    assert got[2] == (None, None, None)     # no rate for the class
    assert got[3] == (0.0, None, None)      # zero cost: no ratio


def test_risk_ranks_golden_row(spark):
    df = spark.createDataFrame([(1, 1, 1, 2, 36)], "erosion_issues int, embankment_fill_issues int, "
                               "blockage_issues int, climate_change_flood_risk int, priority_rank int")
    r = scoring.risk_ranks(df).first()
    assert (r.condition_rank, r.vulnerability_rank, r.overall_rank) == (3, 5, 41)


def test_merged_id(spark):
    df = spark.createDataFrame([(8530, 4600913), (None, 8300042), (None, 250000000)], "own long, ref long")
    got = [r[0] for r in scoring.merged_id(df, "own", "ref", out="agg").select("agg").collect()]
    assert got == [8530, 1008300042, 250000000]


def test_tag_join_golden_rows(spark):
    log = spark.createDataFrame([(1, "09-12-2021 12:50:16 01", "3DD.003E1929EE")], "rowid long, date string, tag_id string")
    fish_rows = spark.createDataFrame([("Cutthroat Trout (General)", 76, 1), ("Cutthroat Trout (General)", 55, None)],
                                      "Species string, Length int, tag_row long")
    out = habitat.tag_join(fish_rows, log).orderBy(F.col("tag_row").asc_nulls_last()).collect()
    assert out[0].tag_id == "3DD.003E1929EE. Row ID 1. " and out[0].date == "09-12-2021 12:50:16 01"
    assert out[1].tag_id is None


def test_file_name_and_length(spark):
    df = spark.createDataFrame([("C:/data/photos/2880/20220907_125320_upstream.JPG",)], "p string")
    r = df.select(file_name("p").alias("n"), text_len(file_name("p")).alias("l")).first()
    assert (r.n, r.l) == ("20220907_125320_upstream.JPG", 28)


def test_fish_chain(spark):
    events = spark.createDataFrame(
        [(1, "electrofishing", 1, 1, "s1_us_ef1", 10.0, 2.0, 300, "closed"),
         (1, "electrofishing", 1, 2, "s1_us_ef1", 10.0, 2.0, 300, "closed"),
         (2, "electrofishing", 1, 1, "s2_ds_ef1", 5.0, 1.0, 200, "open")],
        "reference_number int, sampling_method string, method_number int, haul_number_pass_number int, "
        "local_name string, ef_length_m double, ef_width_m double, ef_seconds int, enclosure string")
    indiv = spark.createDataFrame(
        [(1, "electrofishing", 1, 1, "CO", 60.0), (1, "electrofishing", 1, 1, "CO", 120.0),
         (1, "electrofishing", 1, 2, "CO", 70.0), (1, "electrofishing", 1, 1, "LSU", 200.0)],
        "reference_number int, sampling_method string, method_number int, haul_number_pass_number int, "
        "species_code string, length_mm double")
    rec = fish.fish_records(indiv, events)
    stages = {(r.species_code, r.length_mm): r.life_stage for r in rec.collect()}
    assert stages[("CO", 60.0)] == "fry" and stages[("CO", 120.0)] == "juvenile" and stages[("LSU", 200.0)] is None
    assert stages[("NFC", None)] is None                      # event s2 had no fish
    c = fish.catch_by_pass(rec)
    d = {(r.local_name, r.species_code, r.life_stage): r for r in fish.density(c, events).collect()}
    fry = d[("s1_us_ef1", "CO", "fry")]
    assert fry.catch == 1 and fry.area_m2 == 20.0 and fry.density_100m2 == 5.0
    assert fry.nfc_pass is True                               # caught on pass 1 of 2 only
    assert d[("s1_us_ef1", "CO", "parr")].nfc_pass is False   # caught on the last pass
    assert d[("s2_ds_ef1", "NFC", None)].catch == 0
