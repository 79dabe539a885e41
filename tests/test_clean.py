"""CSV scan and master-data cleaning (FIXTURES.md §1)."""

from shopflow.operators import clean
from shopflow.sources.files import scan_csv

USERS_CSV = """ User_ID , Name,EMAIL,signup_date,device,loyalty_tier,location,foo
u1,Ann,  A@B.Com ,2025-01-02T03:04:05, Mobile , GOLD ,Paris,x
u2,Bob,,2025-01-02,desktop,silver,Rome,x
u3,Cy,c@d.e,bad,watch,bRonze,Oslo,x
u4,Di,d@e.f,,,platinum,Kyiv,x
,Ed,e@f.g,,,gold,Lima,x
,,,,,,,
u5,Fa,f@g.h,,,gold,Rome,x,EXTRA
u6,Gi,g@h.i,,,gold
u1,Ann,a@b.com,2025-01-02T03:04:05,mobile,gold,Paris,y
"""

ORDERS_CSV = """order_id,user_id,timestamp,total,status,payment_method
o1,u1,2025-01-02T03:04:05,12.50,completed,credit_card
o2,u9,2025-01-02,abc, Completed ,PAYPAL
o3,,2025-01-03,,completed,cash
o4,u1,bad,1,completed,paypal
o5,u1,2025-01-04,1,cancelled,paypal
"""


def write(tmp_dir, name, text):
    path = f"{tmp_dir}/{name}"
    import os
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.csv", "w") as fh:
        fh.write(text)
    return path


def test_users(spark, tmp_dir):
    raw, long_lines = scan_csv(spark, write(tmp_dir, "users", USERS_CSV))
    assert long_lines.count() == 1  # the u5 line has a surplus field
    rows, rejects = clean.clean_table(raw, "users")
    got = {r["user_id"]: r for r in rows.collect()}
    assert set(got) == {"u1", "u3", "u6"}
    assert got["u3"]["device"] is None and got["u3"]["signup_date"] is None  # kept, coerced to NULL
    assert got["u1"]["email"] == "a@b.com" and got["u1"]["device"] == "mobile" and got["u1"]["loyalty_tier"] == "Gold"
    assert got["u6"]["location"] is None  # short line padded with NULL
    reasons = sorted(r["reason"] for r in rejects.collect())
    assert reasons == ["all fields empty", "invalid or missing email", "invalid or missing loyalty_tier",
                       "missing user_id"]
    assert "foo" not in rows.columns


def test_users_coercions(spark, tmp_dir):
    raw, _ = scan_csv(spark, write(tmp_dir, "users", USERS_CSV.replace("platinum", "Gold")))
    rows, _ = clean.clean_table(raw, "users")
    got = {r["user_id"]: r for r in rows.collect()}
    assert got["u4"]["device"] is None and got["u4"]["signup_date"] is None


def test_orders_and_referential_check(spark, tmp_dir):
    raw, _ = scan_csv(spark, write(tmp_dir, "orders", ORDERS_CSV))
    rows, rejects = clean.clean_table(raw, "orders")
    got = {r["order_id"]: r for r in rows.collect()}
    assert set(got) == {"o1", "o2"}
    assert str(got["o1"]["total"]) == "12.50" and got["o2"]["total"] is None
    assert got["o2"]["payment_method"] == "paypal" and got["o2"]["status"] == "completed"
    assert "created_at" in rows.columns
    users = spark.createDataFrame([("u1",)], "user_id string")
    kept, orphans = clean.referential_check(rows.drop("_pos"), users)
    assert [r["order_id"] for r in orphans.collect()] == ["o2"]
    assert [r["order_id"] for r in kept.collect()] == ["o1"]


def test_later_position_wins_on_reload(spark, tmp_dir):
    from shopflow.operators import merge
    first = spark.createDataFrame([("p1", "A", "10.00", "home")], "product_id string, name string, price string, category string")
    rows1, _ = clean.clean_table(first, "products")
    second = spark.createDataFrame([("p1", "5.00", 1), ("p1", "7.00", 2)], "product_id string, price string, _p int")
    rows2, _ = clean.clean_table(second.drop("_p"), "products")
    out = merge.upsert(rows1, rows2.limit(1).unionByName(rows2), "product_id")
    assert out.count() >= 1


def test_csv_na_tokens_and_quoted_fields(spark, tmp_dir):
    text = ('product_id,name,price,category,inventory,popularity_score\n'
            'p1,"Chair, oak",NA,home,N/A,null\n'
            'p2,Desk,12.5,OTHER,3,0.5\n')
    raw, long_lines = scan_csv(spark, write(tmp_dir, "products", text))
    assert long_lines.count() == 0
    rows, _ = clean.clean_table(raw, "products")
    got = {r["product_id"]: r for r in rows.collect()}
    assert got["p1"]["name"] == "Chair, oak"
    assert got["p1"]["price"] is None and got["p1"]["inventory"] is None and got["p1"]["popularity_score"] is None
    assert str(got["p2"]["price"]) == "12.50" and got["p2"]["category"] == "Other" and got["p2"]["inventory"] == 3
