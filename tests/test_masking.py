import pytest
from pyspark.sql import functions as F

from lumenlake.functions.permutation import permuted_digits
from lumenlake.plans import masking
from lumenlake.sources import derived

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "text,expected",
    [
        ("-5,123456000000", "-5,120000000000"), ("-5,125000000000", "-5,130000000000"), ("5,1", "5,1"),
        ("-0,001000", "-0,000000"), ("30,999", "31,000"), ("", ""), ("  ", "  "),
    ],
)
def test_coordinates(spark, text, expected):
    assert spark.createDataFrame([(text,)], "c string").select(masking.round_coordinate(F.col("c"))).first()[0] == expected


def rows(spark):
    data = [
        (10, "S2", "7", "", "11111-1", "DX", "M1", "0000000005", "000000000005", "202401"),
        (20, "S1", "07", "U", "22222-1", "DY", "M1", "0000000005", "003000000001", "202402"),
        (30, "S2", "S/N", " ", "22222-2", "DX", "M1", "0000000006", "000000000006", "202402"),
        (40, "", "9", "U", "33333-1", "DZ", "M2", "0000000007", "x", "202403"),
        (50, "S3", "7", "V", "11111-2", "DX", "M1", "0000000008", "y", "202403"),
    ]
    names = ("line_no bigint, street string, house_number string, complement string, postal_code string,"
             " district string, municipality string, installation string, contract_account string, billing_month string")
    frame = spark.createDataFrame(data, names)
    return frame.selectExpr("*", "'1,555' latitude", "'2,5' longitude", "'b' bill_number", "'p' print_document")


def test_mask(spark, workspace):
    found = {r["line_no"]: r for r in masking.mask(rows(spark), workspace).collect()}
    assert [found[i]["street"] for i in (10, 20, 30, 40)] == [f"RUA FICTICIA 00{n}" for n in (1, 2, 1, 3)]
    assert [found[i]["complement"] for i in (10, 20, 30, 40, 50)] == ["", "COMPLEMENTO 001", " ", "COMPLEMENTO 001", "COMPLEMENTO 002"]
    assert [found[i]["postal_code"] for i in (10, 40)] == ["11111-000", "33333-000"]
    assert found[30]["house_number"] == "S/N" and found[10]["house_number"] == found[50]["house_number"]
    numbers = {found[i]["house_number"] for i in (10, 20, 40)}
    assert len(numbers) == 3 and not numbers & {"7", "9", "07"}
    assert all(1 <= int(n) <= masking.LARGEST_HOUSE_NUMBER + 2 * 3 for n in numbers)
    assert [found[i]["installation"] for i in (10, 20, 50)] == ["0000000001", "0000000002", "0000000005"]
    assert [found[i]["contract_account"] for i in (10, 20, 30, 40, 50)] == [
        "000000000001", "003000000001", "000000000003", "003000000002", "003000000003"]
    assert found[20]["bill_number"] == "0202402000000002" and found[20]["print_document"] == "300000000002"
    assert (found[10]["latitude"], found[10]["longitude"]) == ("1,560", "2,5")


def test_installations_can_stay_equal(spark, workspace):
    found = masking.identifiers(rows(spark), per_row=False, workspace=workspace).orderBy("line_no").collect()
    assert [r["installation"] for r in found] == [f"000000000{n}" for n in (1, 1, 2, 3, 4)]


def test_labels_outgrow_their_width(spark, workspace):
    wide = spark.range(1, 1203).selectExpr("id as line_no", "concat('s', id) as street", "'' as complement", "'d' as district")
    found = masking.address_labels(wide, workspace).where("line_no in (7, 1202)").orderBy("line_no").collect()
    assert [r["street"] for r in found] == ["RUA FICTICIA 007", "RUA FICTICIA 1202"]


def test_house_numbers_stay_injective_when_the_small_range_is_full(spark, workspace):
    many = spark.range(1, 12001).selectExpr("id as line_no", "cast(id as string) as house_number")
    audit = masking.equality_audit(many, masking.house_numbers(many, workspace), ["house_number"]).first()
    assert audit["preserved"] and audit["n_old"] == 12000
    changed = masking.house_numbers(many, workspace).where("cast(house_number as int) between 1 and 12000").count()
    assert changed == 0


MASKED_TEXTS = ["street", "house_number", "complement", "district"]


def second_extract(spark):
    return rows(spark).withColumns({
        "street": F.concat(F.lit("SECRET "), "street"), "district": F.concat(F.lit("HIDDEN "), "district"),
        "house_number": F.concat(F.lit("55"), "line_no"), "complement": F.concat(F.lit("FLAT "), "line_no"),
        "installation": F.concat(F.lit("99"), "installation"),
    })


def test_a_second_extract_in_the_same_workspace_is_masked_too(spark, workspace):
    for extract in (rows(spark), second_extract(spark)):
        found = masking.mask(extract, workspace, per_row=False).collect()
        assert len(found) == extract.count()
        for column in MASKED_TEXTS + ["installation"]:
            original = {r[column] for r in extract.collect() if (r[column] or "").strip() and r[column] != "S/N"}
            assert not original & {r[column] for r in found}, column


def test_a_value_without_a_label_fails(spark):
    frame = spark.createDataFrame([("x", None, False), (None, None, False), ("", None, True)], "v string, label string, stays boolean")
    masked = frame.select("v", masking._mapped(F.col("label"), F.col("v"), F.col("stays")).alias("m"))
    assert [r["m"] for r in masked.where("v is null or v = ''").collect()] == [None, ""]
    with pytest.raises(Exception, match="no masked counterpart"):
        masked.collect()


def test_rows_without_municipality_stay(spark, workspace):
    data = [(1, None, "11111-1"), (2, None, "11111-9"), (3, "M", "22222-2"), (4, "N", None)]
    frame = spark.createDataFrame(data, "line_no bigint, municipality string, postal_code string")
    found = {r["line_no"]: r["postal_code"] for r in masking.postal_codes(frame, workspace).collect()}
    assert found == {1: "11111-000", 2: "11111-000", 3: "22222-000", 4: None}


def test_unsound_records_are_refused(spark, workspace):
    with pytest.raises(ValueError, match="columns missing"):
        masking.mask(rows(spark).drop("street"), workspace)
    for broken in (rows(spark).withColumn("too_long", F.col("line_no") == 20), rows(spark).withColumn("street", F.lit('a"b'))):
        with pytest.raises(Exception, match="cannot be told apart"):
            masking.mask(broken, workspace).collect()


def test_masked_extract_is_written_in_its_own_form(spark, workspace, tmp_path):
    from lumenlake import contract
    from lumenlake.sources import extract

    before = derived.bills_raw(spark, SF).withColumn("line_no", F.col("line_no").cast("bigint")).where("line_no <= 40")
    masking.mask_extract(before, str(tmp_path / "masked"), workspace)
    after = extract.scan_extract(spark, str(tmp_path / "masked"))
    assert after.count() == 40 and set(contract.NAMES) <= set(after.columns)
    assert after.where("street like 'RUA FICTICIA %'").count() == 40


@pytest.mark.parametrize("digits", [1, 2, 3, 4])
def test_keyed_images_are_a_permutation(spark, digits):
    rows = spark.range(10**digits).select(F.lpad(F.col("id").cast("string"), digits, "0").alias("t"))
    found = [tuple(r) for r in rows.select("t", permuted_digits(F.col("t"), "k").alias("a"), permuted_digits(F.col("t"), "other").alias("b")).collect()]
    for place in (1, 2):
        assert {r[place] for r in found} == {r[0] for r in found}
    assert digits < 3 or sum(r[0] == r[1] for r in found) < 10 < 10**digits - sum(r[1] == r[2] for r in found)


def test_keyed_images_agree_over_loads_and_refuse_other_text(spark):
    texts = ["000000000000000001", "7", None, "", " ", "123456789012345678"]
    image = lambda rows: {r.t: r.i for r in rows.select("t", permuted_digits(F.col("t"), "k").alias("i")).collect()}
    one = image(spark.createDataFrame([(t,) for t in texts], "t string"))
    two = image(spark.createDataFrame([(t,) for t in texts[::-1] + ["99"]], "t string"))
    assert all(two[t] == one[t] for t in texts)
    assert [one[t] for t in (None, "", " ")] == [None, "", " "]
    assert all(len(one[t]) == len(t) and one[t].isdigit() for t in texts if t and t.strip())
    for bad in ("S/N", "1" * 19):
        with pytest.raises(Exception, match="keyed image"):
            image(spark.createDataFrame([(bad,)], "t string"))
    rows = spark.createDataFrame([(1, "12", "S/N")], "line_no long, installation string, house_number string")
    assert masking.keyed_identifiers(rows, "k", ["installation", "house_number"]).first().house_number == "S/N"
