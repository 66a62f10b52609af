"""The two benchmark schema sets, in the short column notation of ``TableSpec.parse``."""

from __future__ import annotations

from rowtide.catalog.spec import TableSpec

# Table name, declared record size, key columns in key order, columns.
# Every table also ends in the freshness column.
FRESHNESS = "freshness_ts timestamp(6)"

_CH = [
    ("warehouse", 101, "w_id",
     "w_id int32!, w_name char(10)!, w_street_1 char(20)!, w_street_2 char(20)!, "
     "w_city char(20)!, w_state char(2)!, w_zip char(9)!, w_tax float32!, w_ytd float32!"),
    ("district", 109, "d_w_id, d_id",
     "d_id int32!, d_w_id int32!, d_name char(10)!, d_street_1 char(20)!, "
     "d_street_2 char(20)!, d_city char(20)!, d_state char(2)!, d_zip char(9)!, "
     "d_tax float32!, d_ytd float32!, d_next_o_id int32!"),
    ("customer", 675, "c_id, c_w_id, c_d_id",
     "c_id int32!, c_d_id int32!, c_w_id int32!, c_first char(16)!, c_middle char(2)!, "
     "c_last char(16)!, c_street_1 char(20)!, c_street_2 char(20)!, c_city char(20)!, "
     "c_state char(2)!, c_zip char(9)!, c_phone char(16)!, c_since date!, c_credit char(2)!, "
     "c_credit_lim float32!, c_discount float32!, c_balance float32!, c_ytd_payment float32!, "
     "c_payment_cnt int32!, c_delivery_cnt int32!, c_data char(500), c_n_nationkey int32"),
    ("history", 545, "h_c_id, h_c_d_id, h_c_w_id, h_d_id, h_w_id, h_date",
     "h_c_id int32!, h_c_d_id int32!, h_c_w_id int32!, h_d_id int32!, h_w_id int32!, "
     "h_date timestamp(6)!, h_amount float32!, h_data char(500)"),
    ("neworder", 20, "no_w_id, no_d_id, no_o_id",
     "no_o_id int32!, no_d_id int32!, no_w_id int32!"),
    ("order", 49, "o_w_id, o_d_id, o_id",
     "o_id int32!, o_d_id int32!, o_w_id int32!, o_c_id int32!, o_entry_d date!, "
     "o_carrier_id int32, o_ol_cnt int32!, o_all_local int32!"),
    ("orderline", 89, "ol_w_id, ol_d_id, ol_o_id, ol_number",
     "ol_o_id int32!, ol_d_id int32!, ol_w_id int32!, ol_number int32!, ol_i_id int32!, "
     "ol_supply_w_id int32!, ol_delivery_d date, ol_quantity int32!, ol_amount float32!, "
     "ol_dist_info char(32)"),
    ("item", 113, "i_id",
     "i_id int32!, i_im_id int32!, i_name char(32)!, i_price float32!, i_data char(50)"),
    ("stock", 297, "s_w_id, s_i_id",
     "s_i_id int32!, s_w_id int32!, s_quantity int32!, "
     + ", ".join(f"s_dist_{n:02d} char(32)" for n in range(1, 11))
     + ", s_ytd int32!, s_order_cnt int32!, s_remote_cnt int32!, s_data char(50), "
     "s_su_suppkey int32"),
    ("nation", 189, "n_nationkey",
     "n_nationkey int32!, n_name char(25)!, n_regionkey int32!, n_comment char(152)"),
    ("supplier", 207, "su_suppkey",
     "su_suppkey int32!, su_name char(25)!, su_address char(40)!, su_nationkey int32!, "
     "su_phone char(15)!, su_acctbal float32!, su_comment char(101)"),
    ("region", 219, "r_regionkey",
     "r_regionkey int32!, r_name char(55)!, r_comment char(152)"),
]

_HY = [
    ("customer", 114, "custID",
     "custID int32!, companyID int32, gender varchar(6), name varchar(15), age int32, "
     "phone varchar(11), province varchar(15), city varchar(15), loan_balance float32, "
     "saving_credit int32, checking_credit int32, loan_credit int32, Isblocked int32, "
     "created_date date, last_update_timestamp timestamp(6)"),
    ("company", 209, "companyID",
     "companyID int32!, name varchar(60), category varchar(60), staff_size int32, "
     "loan_balance float32, phone varchar(11), province varchar(15), city varchar(15), "
     "saving_credit int32, checking_credit int32, loan_credit int32, Isblocked int32, "
     "created_date date, last_update_timestamp timestamp(6)"),
    ("savingaccount", 32, "accountID",
     "accountID int32!, userID int32, balance float32, Isblocked int32, ts timestamp(6)"),
    ("checkingaccount", 32, "accountID",
     "accountID int32!, userID int32, balance float32, Isblocked int32, ts timestamp(6)"),
    ("transfer", 46, "id",
     "id int64!, sourceID int32, targetID int32, amount float32, type char(10), "
     "ts timestamp(6)"),
    ("checking", 42, "id",
     "id int32!, sourceID int32, targetID int32, amount float32, type char(10), "
     "ts timestamp(6)"),
    ("loanapps", 44, "id",
     "id int32!, applicantID int32, amount float32, duration int32, status char(12), "
     "ts timestamp(6)"),
    ("loantrans", 60, "id",
     "id int32!, applicantID int32, appID int32, amount float32, status char(12), "
     "ts timestamp(6), duration int32, contract_timestamp timestamp(6), delinquency int32"),
]


def _build(rows) -> dict[str, TableSpec]:
    return {
        name: TableSpec.parse(name, pk, f"{columns}, {FRESHNESS}", size)
        for name, size, pk, columns in rows
    }


CH_BENCHMARK = _build(_CH)
HYBENCH = _build(_HY)

# Names under which a schema set can be asked for.
SCHEMA_SETS = {"chbenchmark": CH_BENCHMARK, "tpch": CH_BENCHMARK, "hybench": HYBENCH}
