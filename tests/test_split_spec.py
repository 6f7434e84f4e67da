import datetime as dt

import pytest

from tablexport.plans.job import ExportJob
from tablexport.plans.split_spec import KeyType, Operation, SplitSpec, SplitSpecError, split_fields


def test_split_fields_respects_quotes():
    assert split_fields('T,query,"a;b,c",like,d') == ["T", "query", '"a;b,c"', "like", "d"]
    assert split_fields("a,,b") == ["a", "", "b"]


def test_number_between_full():
    s = SplitSpec.parse("orders,between,o_orderkey,number,5000,0,14999")
    assert (s.table, s.operation, s.column, s.key_type) == ("orders", Operation.between, "o_orderkey", KeyType.number)
    assert (s.increment, s.start, s.end, s.prefix) == (5000, 0, 14999, None)


def test_number_between_auto_bounds_and_increment():
    s = SplitSpec.parse("orders,between,o_orderkey,number")
    assert s.increment is None and s.start is None and s.end is None
    s = SplitSpec.parse("orders,between,o_orderkey,number,1000")
    assert s.increment == 1000 and s.start is None


def test_like_with_prefix():
    s = SplitSpec.parse("customer,like,c_name,number,1,0,1,Customer#00000")
    assert s.prefix == "Customer#00000" and (s.start, s.end) == (0, 1)


def test_query_with_sub_like():
    s = SplitSpec.parse('T,query,"a;b",like,c')
    assert s.columns == ("a", "b") and s.sub_operation is Operation.like and s.sub_column == "c"
    assert s.key_columns == ("a", "b")


def test_query_plain():
    s = SplitSpec.parse('orders,query,"o_orderstatus;o_orderpriority"')
    assert s.columns == ("o_orderstatus", "o_orderpriority") and s.sub_operation is None


def test_date_bounds_are_kept():
    s = SplitSpec.parse("orders,range,o_orderdate,date,12,2015-01-01,2020-06-30")
    assert s.start == dt.datetime(2015, 1, 1) and s.end == dt.datetime(2020, 6, 30)


@pytest.mark.parametrize("text", [
    "T,k,between,number,1,0,10",          # help-text field order: second field must be an operation
    "T,between",                          # fewer than three fields
    "T,between,k,number,1,0",             # start without end
    "T,range,k,number,1,0,10",            # number range loops forever in the original
    "T,like,k,number,0,1,9",              # increment 0 loops forever
    "T,like,k,number",                    # like without range or increment
    "T,between,k,string,1,a,z",           # string between unsupported
    "T,range,k,date",                     # date without increment
    "T,between,k,number,-1,0,10",         # negative increment
])
def test_rejected(text):
    with pytest.raises(SplitSpecError):
        SplitSpec.parse(text)


def test_table_match_case_insensitive_and_schema():
    s = SplitSpec.parse("DBO.Orders,between,o_orderkey,number")
    assert s.matches_table("dbo", "orders")
    assert not s.matches_table("sales", "orders")
    s = SplitSpec.parse("ORDERS,between,o_orderkey,number")
    assert s.matches_table("anything", "orders")


def test_job_validates():
    with pytest.raises(ValueError):
        ExportJob(destination="x", codec="zstd")
    with pytest.raises(SplitSpecError):
        ExportJob(destination="x", split_strategies=("T,between",))
    j = ExportJob(destination="x", split_strategies=("dbo.t,between,k,number", "other,between,k,number"))
    assert [s.table for s in j.specs_for("dbo", "t")] == ["dbo.t"]
