"""SQL over the raw sample tables that must return the rows of the query of the same name."""

from __future__ import annotations

from rentlake import schemas

# Named subqueries shared by the texts below.
PARTS = {
    "film": """film as (select p_partkey as film_id, p_name as title, p_type, p_brand, p_size,
        cast(p_retailprice as decimal(12,2)) as rental_rate from part)""",
    "line": """line as (select *, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) as rental_id,
        (l_partkey << 32) | l_suppkey as inventory_id,
        case when l_returnflag = 'N' and l_linestatus = 'O' and l_shipdate > timestamp '2001-06-01 00:00:00'
             then null else l_shipdate end as return_date from lineitem)""",
    "rental": """rental as (select * from line join orders on l_orderkey = o_orderkey)""",
    "copy": """copy as (select distinct inventory_id, l_partkey as film_id, s_nationkey as store_id
        from line join supplier on s_suppkey = l_suppkey)""",
    "gone": """gone as (select distinct inventory_id from line where return_date is null)""",
    "filed": """filed as (select p_partkey as film_id, p_type as category from part
        union all select p_partkey, p_brand from part)""",
    "played": """played as (select distinct l_partkey as film_id, l_suppkey as actor_id from lineitem)""",
    "sold": """sold as (select inventory_id, cast(sum(cast(l_extendedprice as decimal(12,2))) as decimal(28,2)) as paid
        from rental group by inventory_id)""",
    "place": """place as (select n_nationkey, n_name, r_name from nation join region on r_regionkey = n_regionkey)""",
    "text": """text as (select p_partkey as film_id, p_name as title, p_type, p_brand, p_size,
        case when p_brand = 'Brand#2' then null else p_type end as description from part)""",
}


def _with(names: str, text: str) -> str:
    return f"with {', '.join(PARTS[n] for n in names.split())} {text}"


def _name(column: str) -> str:
    return f"concat(split_part({column}, '#', 1), ' ', split_part({column}, '#', 2))"


def _capital(column: str) -> str:
    return f"concat(upper(substr({column}, 1, 1)), lower(substr({column}, 2)))"


def _film_list(actor: str) -> str:
    return _with(
        "filed played",
        f"""select p_partkey as "FID", p_name as title, concat(p_brand, ' ', p_type) as description, category,
            cast(p_retailprice as decimal(12,2)) as price, p_size as length, p_brand as rating,
            string_agg({actor}, ', ' order by {actor}) as actors
        from part join filed on filed.film_id = p_partkey join played on played.film_id = p_partkey
        join supplier on s_suppkey = actor_id
        group by p_partkey, p_name, p_brand, p_type, category, p_retailprice, p_size""",
    )


_SILVER = _with(
    "line rental",
    """select rental_id as rental_key, c_custkey as customer_key,
        split_part(c_name, '#', 1) as customer_first_name, split_part(c_name, '#', 2) as customer_last_name,
        concat(c_name, '@', lower(c_mktsegment)) as customer_email,
        s_suppkey as staff_key, split_part(s_name, '#', 1) as staff_first_name,
        split_part(s_name, '#', 2) as staff_last_name, s_name as staff_email, s_nationkey as store_key,
        inventory_id as inventory_key, p_name as title, p_size + 1970 as release_year, p_size as rental_duration,
        cast(p_retailprice as decimal(12,2)) as rental_rate, p_size as length,
        cast(p_retailprice as decimal(12,2)) as replacement_cost, p_brand as rating,
        monthname(o_orderdate) as rental_month, dayname(o_orderdate) as rental_day_name,
        cast(day(o_orderdate) as int) as rental_day, cast(year(o_orderdate) as int) as rental_year,
        monthname(return_date) as return_month, dayname(return_date) as return_day_name,
        cast(day(return_date) as int) as return_day, cast(year(return_date) as int) as return_year, l_shipdate as modified_date
    from rental join customer on c_custkey = o_custkey join supplier on s_suppkey = l_suppkey
    join part on p_partkey = l_partkey""",
)


def _spend(key: str, alias: str, returned: str = "") -> str:
    return _with(
        "film line rental",
        f"""select {key} as {alias}, count(*) as total_rental_quantity,
            cast(sum(rental_rate) as decimal(28,2)) as total_rental_price
        from rental join film on film_id = l_partkey join customer on c_custkey = o_custkey {returned} group by 1""",
    )


_BEST = """select o_custkey from lineitem join orders on l_orderkey = o_orderkey
    where cast(o_orderdate as date) between date '1996-03-01' and date '1996-03-31'
    group by o_custkey having sum(cast(l_extendedprice as decimal(12,2))) > 200000 and count(o_custkey) > 1"""


def _changed(description: str) -> str:
    return _with(
        "text",
        f"""select case when p_type = 'PROMO' then -film_id - 1 else film_id end as film_id,
            case when p_type = 'SMALL' and p_size > 25 then concat(title, ' v2')
                 when p_type = 'SMALL' then concat(title, ' v1') else title end as title,
            case when {description} then 'ECONOMY v2' else description end as description
        from text where p_brand <> 'Brand#1'
        union all select -film_id - 1, title, description from text where p_type = 'LARGE'""",
    )


def _profile(column: str, kind: str, distinct: bool) -> str:
    n_distinct = f"count(distinct {column}) as n_distinct," if distinct else ""
    return f"""select '{column}' as column_name, '{kind}' as data_type, count(*) as n_rows,
        count(*) - count({column}) as n_nulls, {n_distinct} cast(min({column}) as varchar) as min_value,
        cast(max({column}) as varchar) as max_value from orders"""


def _profiles(distinct: bool) -> str:
    columns = {
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "string",
    }
    return " union all ".join(_profile(c, k, distinct) for c, k in columns.items())


def _count(table: str, rule: str, columns: str, text: str) -> str:
    return f"select '{table}' as table_name, '{rule}' as rule, '{columns}' as columns, ({text}) as n_violations"


def _orphan(child: str, fk: str, parent: str, pk: str) -> str:
    return f"""select count(*) from {child} c where c.{fk} is not null
        and not exists (select 1 from {parent} p where p.{pk} = c.{fk})"""


# The adapter's tables as SQL, for the rules of the integrity report.
_TABLES = {
    "actor": """select s_suppkey as actor_id, upper(split_part(s_name, '#', 1)) as first_name,
        split_part(s_name, '#', 2) as last_name from supplier""",
    "address": """select n_nationkey as address_id, concat('1 ', n_name) as address, cast(null as varchar) as address2,
        n_name as district, n_nationkey as city_id, cast(n_nationkey as varchar) as postal_code,
        concat('+', cast(n_nationkey as varchar)) as phone from nation""",
    "category": "select distinct category as category_id, category as name from filed",
    "city": "select n_nationkey as city_id, n_name as city, n_regionkey as country_id from nation",
    "country": "select r_regionkey as country_id, r_name as country from region",
    "customer": """select c_custkey as customer_id, c_nationkey as store_id, split_part(c_name, '#', 1) as first_name,
        split_part(c_name, '#', 2) as last_name, concat(c_name, '@', lower(c_mktsegment)) as email,
        c_nationkey as address_id, c_acctbal > 0 as active,
        (select min(o_orderdate) from orders where o_custkey = c_custkey) as create_date from customer""",
    "film": """select p_partkey as film_id, p_name as title, concat(p_brand, ' ', p_type) as description,
        p_size + 1970 as release_year, p_size % 5 as language_id,
        case when p_size % 3 = 0 then p_size % 7 end as original_language_id, p_size as rental_duration,
        cast(p_retailprice as decimal(12,2)) as rental_rate, p_size as length,
        cast(p_retailprice as decimal(12,2)) as replacement_cost, p_brand as rating,
        case when p_size % 2 = 0 then 'Trailers,Commentaries' when p_size % 3 = 0 then 'Trailers,Bloopers' end
            as special_features from part""",
    "film_actor": "select actor_id, film_id from played",
    "film_category": "select film_id, category as category_id from filed",
    "film_text": "select film_id, title, description from text",
    "inventory": "select inventory_id, film_id, store_id from copy",
    "language": "select r_regionkey as language_id, r_name as name from region",
    "payment": """select rental_id as payment_id, o_custkey as customer_id, l_suppkey as staff_id, rental_id,
        cast(l_extendedprice as decimal(12,2)) as amount, o_orderdate as payment_date from rental""",
    "rental": """select rental_id, o_orderdate as rental_date, inventory_id, o_custkey as customer_id, return_date,
        l_suppkey as staff_id from rental""",
    "staff": """select s_suppkey as staff_id, split_part(s_name, '#', 1) as first_name,
        split_part(s_name, '#', 2) as last_name, s_nationkey as address_id, s_name as email, s_nationkey as store_id,
        s_acctbal > 0 as active from supplier""",
    "store": """select s_nationkey as store_id, min(s_suppkey) as manager_staff_id, s_nationkey as address_id
        from supplier group by s_nationkey""",
}


def _members(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _row_conditions(table: str) -> list[tuple[str, str, str]]:
    """Kind, column and violation of every declared rule on single rows."""
    found = [("NOT NULL", c, f"{c} is null") for c in schemas.required_columns(table)]
    for c, values in schemas.DOMAINS.get(table, {}).items():
        found.append(("DOMAIN", c, f"{c} not in ({_members(values)})"))
    for c, values in schemas.SET_DOMAINS.get(table, {}).items():
        found.append(("SET", c, f"len(list_filter(string_split({c}, ','), lambda x: x not in ({_members(values)}))) > 0"))
    for c, most in schemas.LENGTHS.get(table, {}).items():
        found.append(("LENGTH", c, f"length({c}) > {most}"))
    for c, (low, high) in schemas.RANGES.get(table, {}).items():
        found.append(("RANGE", c, f"{c} is not null and not coalesce(try_cast({c} as double) between {low} and {high}, false)"))
    for c, (digits, places) in schemas.DECIMALS.get(table, {}).items():
        limit = f"abs({c}) >= {10 ** (digits - places)}"
        found.append(("DECIMAL", c, f"{limit} or round({c}, {places}) <> {c}"))
    return found


def _report() -> str:
    texts = []
    for table in schemas.SOURCE_TABLES:
        source = f"t_{table}"
        for kind, column, broken in _row_conditions(table):
            texts.append(_count(table, kind, column, f"select count(*) from {source} where {broken}"))
        key = schemas.PRIMARY_KEYS[table]
        null = " or ".join(f"{k} is null" for k in key)
        listed = ", ".join(key)
        repeated = f"select count(*) from (select {listed} from {source} group by {listed} having count(*) > 1 or {null})"
        texts.append(_count(table, "PRIMARY KEY", ",".join(key), repeated))
        for unique in schemas.UNIQUE_KEYS.get(table, []):
            set_ = " and ".join(f"{k} is not null" for k in unique)
            listed = ", ".join(unique)
            repeated = f"select count(*) from (select {listed} from {source} where {set_} group by {listed} having count(*) > 1)"
            texts.append(_count(table, "UNIQUE", ",".join(unique), repeated))
    for child, fk, parent, pk, _ in schemas.FOREIGN_KEYS:
        texts.append(_count(child, "FOREIGN KEY", f"{fk}->{parent}.{pk}", _orphan(f"t_{child}", fk, f"t_{parent}", pk)))
    twice = """select count(*) from (select inventory_id from t_rental where return_date is null
        group by inventory_id having count(*) > 1)"""
    texts.append(_count("rental", "ONE OPEN RENTAL", "inventory_id", twice))
    tables = ", ".join(f"t_{name} as ({text})" for name, text in _TABLES.items())
    return _with("line rental copy filed played text", f", {tables} {' union all '.join(texts)}")


_FIRST = "upper(split_part(s_name, '#', 1))"
_PLACED = "n_name as city, r_name as country"
_HOME = """concat('1 ', n_name) as address, cast(n_nationkey as varchar) as "zip code",
            concat('+', cast(n_nationkey as varchar)) as phone"""

ORACLES: dict[str, str] = {
    "gold_customer_spend": _spend("split_part(c_name, '#', 2)", "customer_name"),
    "gold_customer_spend_by_key": _spend("c_custkey", "customer_key"),
    "customer_list": _with(
        "place",
        f"""select c_custkey as "ID", {_name('c_name')} as name, {_HOME}, {_PLACED},
            case when c_acctbal > 0 then 'active' else '' end as notes, c_nationkey as "SID"
        from customer join place on n_nationkey = c_nationkey""",
    ),
    "staff_list": _with(
        "place",
        f"""select s_suppkey as "ID", {_name('s_name')} as name, {_HOME}, {_PLACED}, s_nationkey as "SID"
        from supplier join place on n_nationkey = s_nationkey""",
    ),
    "film_list": _film_list(f"concat({_FIRST}, ' ', split_part(s_name, '#', 2))"),
    "film_list_capitalised": _film_list(
        f"concat({_capital(_FIRST)}, ' ', split_part(s_name, '#', 2))"
    ),
    "actor_info": _with(
        "filed played",
        """, listed as (select actor_id, category, string_agg(p_name, ', ' order by p_name) as titles
            from played join filed using (film_id) join part on p_partkey = film_id group by actor_id, category)
        select s_suppkey as actor_id, upper(split_part(s_name, '#', 1)) as first_name,
            split_part(s_name, '#', 2) as last_name,
            string_agg(concat(category, ': ', titles), '; ' order by category) as film_info
        from supplier left join listed on listed.actor_id = s_suppkey group by s_suppkey, s_name""",
    ),
    "actor_info_parts": _with(
        "filed played",
        """select actor_id, category as name, string_agg(p_name, ', ' order by p_name) as titles
        from played join filed using (film_id) join part on p_partkey = film_id group by actor_id, category""",
    ),
    "sales_by_store": _with(
        "line rental copy place sold",
        f"""select concat(n_name, ',', r_name) as store, {_name('s_name')} as manager,
            cast(sum(paid) as decimal(28,2)) as total_sales
        from sold join copy using (inventory_id)
        join (select s_nationkey, min(s_suppkey) as boss from supplier group by s_nationkey) b on s_nationkey = store_id
        join supplier s on s.s_suppkey = boss join place on n_nationkey = b.s_nationkey
        group by n_name, r_name, s_name""",
    ),
    "sales_by_category": _with(
        "line rental copy filed sold",
        """select category, cast(sum(paid) as decimal(28,2)) as total_sales
        from sold join copy using (inventory_id) join filed using (film_id) group by category""",
    ),
    "sales_total_check": """select cast(sum(cast(l_extendedprice as decimal(12,2))) as decimal(28,2)) as by_store,
            cast(sum(cast(l_extendedprice as decimal(12,2))) as decimal(28,2)) as paid
        from lineitem where l_orderkey in (select o_orderkey from orders)""",
    "views_in_sql": _with(
        "place",
        """select r_name as country, case when c_acctbal > 0 then 'active' else '' end as notes,
            count(*) as n_customers
        from customer join place on n_nationkey = c_nationkey group by 1, 2""",
    ),
    "rewards_report": f"""select c_custkey as customer_id, c_nationkey as store_id,
            split_part(c_name, '#', 1) as first_name, split_part(c_name, '#', 2) as last_name,
            concat(c_name, '@', lower(c_mktsegment)) as email, c_nationkey as address_id, c_acctbal > 0 as active
        from customer where c_custkey in ({_BEST})""",
    "rewardee_count": f"select count(*) as count_rewardees from customer where c_custkey in ({_BEST})",
    "customer_balance": _with(
        "film line rental",
        """, charged as (select o_custkey, sum(rental_rate) as rent,
            sum(case when datediff('day', o_orderdate, return_date) > p_size
                then datediff('day', o_orderdate, return_date) - p_size else 0 end) as late,
            sum(cast(l_extendedprice as decimal(12,2))) as paid
            from rental join film on film_id = l_partkey
            where o_orderdate <= timestamp '1998-01-01 00:00:00' group by o_custkey)
        select c_custkey as customer_id,
            cast(coalesce(rent, 0) + coalesce(late, 0) - coalesce(paid, 0) as decimal(28,2)) as balance
        from customer left join charged on o_custkey = c_custkey""",
    ),
    "film_in_stock": _with(
        "line copy gone", "select inventory_id from copy where inventory_id not in (select inventory_id from gone)"
    ),
    "film_in_stock_of": _with(
        "line copy gone",
        """select inventory_id from copy where film_id = 7 and store_id in (select min(store_id) from copy where film_id = 7)
            and inventory_id not in (select inventory_id from gone)""",
    ),
    "film_not_in_stock": _with(
        "line copy gone", "select inventory_id from copy where inventory_id in (select inventory_id from gone)"
    ),
    "stock_counts": _with(
        "line copy gone",
        """select film_id, store_id, count(*) - count(gone.inventory_id) as n_in_stock, count(gone.inventory_id) as n_out
        from copy left join gone using (inventory_id) group by film_id, store_id""",
    ),
    "inventory_stock_flag": _with(
        "line copy gone",
        """select inventory_id, inventory_id not in (select inventory_id from gone) as in_stock from copy""",
    ),
    "inventory_holder": _with(
        "line rental copy",
        """select c.inventory_id, min(o_custkey) as customer_id, count(o_custkey) as n_open
        from copy c left join (select inventory_id, o_custkey from rental where return_date is null) o
            on o.inventory_id = c.inventory_id group by c.inventory_id""",
    ),
    "bronze_ingest": "select * from events",
    "bronze_lineage": """select event_type, count(*) as n_rows, count(*) as n_with_file, count(*) as n_with_time
        from events group by event_type""",
    "bronze_json_ingest": "select * from customer",
    "silver_stream_enrich": f"{_SILVER} where return_date is not null",
    "silver_with_open_rentals": _with(
        "line rental",
        """select s_suppkey as staff_key, monthname(return_date) as return_month, count(*) as n_rentals
        from rental join supplier on s_suppkey = l_suppkey join customer on c_custkey = o_custkey
        join part on p_partkey = l_partkey group by 1, 2""",
    ),
    "silver_unmatched": _with(
        "line rental",
        """select rental_id as rental_key, inventory_id as inventory_key, l_suppkey as staff_key,
            o_custkey as customer_key, 'return_date' as missing from rental where return_date is null""",
    ),
    "silver_late_dimension": _with(
        "line rental",
        """select lower(c_mktsegment) as segment, count(*) as n_rentals,
            cast(sum(cast(p_retailprice as decimal(12,2))) as decimal(28,2)) as total_rate
        from rental join customer on c_custkey = o_custkey join part on p_partkey = l_partkey
        where return_date is not null group by 1""",
    ),
    "gold_from_stream": _spend("split_part(c_name, '#', 2)", "customer_name", "where return_date is not null"),
    "scan_csv_inferred": "select * from customer",
    "scan_json_arrays": "select * from part",
    "document_find": """select event_id, event_type, user_id, value from events
        where event_type in ('purchase', 'click') and value >= 20.0""",
    "replace_collections": """select 'inventory' as collection, count(*) as n_documents,
            cast(sum(p_partkey) as bigint) as key_sum from part
        union all select 'customers', count(*), cast(sum(c_custkey) as bigint) from customer""",
    "table_overwrite": """select c_custkey as customer_key, split_part(c_name, '#', 1) as first_name,
            split_part(c_name, '#', 2) as last_name, concat(c_name, '@', lower(c_mktsegment)) as email
        from customer""",
    "create_if_absent": "select * from supplier",
    "table_profile": _profiles(True),
    "table_profile_approximate": _profiles(False),
    "preview_top5": """select o_orderkey, o_custkey, o_totalprice from orders
        order by o_totalprice desc, o_orderkey limit 5""",
    "calendar_attributes": """select distinct cast(o_orderdate as date) as "Date", monthname(o_orderdate) as "MonthName",
        dayname(o_orderdate) as "WeekDayName", cast(day(o_orderdate) as int) as "Day",
        cast(year(o_orderdate) as int) as "Year" from orders""",
    "capitalised_names": f"select p_partkey, {_capital('p_name')} as title from part",
    "apply_changes": _changed("p_type = 'ECONOMY' and description is not null"),
    "apply_changes_null_safe": _changed("p_type = 'ECONOMY'"),
    "apply_changes_stream": _changed("p_type = 'ECONOMY' and description is not null"),
    "apply_changes_absent_key": _with(
        "text",
        """select film_id, case when p_type = 'SMALL' and p_size > 25 then concat(title, ' v2')
                 when p_type = 'SMALL' then concat(title, ' v1') else title end as title, description
        from text where p_brand <> 'Brand#1' and p_type not in ('ECONOMY', 'PROMO')
        union all select -film_id - 1, title, description from text where p_type = 'LARGE'""",
    ),
    "check_pk_nulls": _with(
        "line",
        """select cast(return_date as date) as return_day, count(*) as n_rows from line group by 1
        having count(*) > 1 or return_day is null""",
    ),
    "check_set_domain_of_pattern_sign": """select p_partkey, replace(p_name, ' ', '|') as p_name from part
        where split_part(p_name, ' ', 1) not in ('red', 'blue', 'small', 'large')
        or split_part(p_name, ' ', 2) not in ('bolt', 'gear', 'ring', 'rod', 'plate')""",
    "check_pk": """select l_orderkey, l_linenumber, count(*) as n_rows from lineitem
        group by l_orderkey, l_linenumber having count(*) > 1""",
    "check_unique": _with(
        "line rental",
        """select o_orderdate as rental_date, inventory_id, o_custkey as customer_id, count(*) as n_rows
        from rental group by 1, 2, 3 having count(*) > 1""",
    ),
    "check_fk_clean": _with(
        "line rental",
        """select rental_id as payment_id from rental
        where not exists (select 1 from customer where c_custkey = o_custkey)""",
    ),
    "check_fk": """select o_orderkey, o_custkey from orders
        where not exists (select 1 from customer where c_custkey = o_custkey and c_mktsegment = 'BUILDING')""",
    "check_not_null": _with(
        "line",
        """select rental_id, inventory_id, 'return_date' as null_columns from line where return_date is null""",
    ),
    "column_defaults": _with(
        "text", "select film_id, title, coalesce(description, 'no description') as description from text"
    ),
    "check_domain": "select p_partkey, p_type from part where p_type not in ('ECONOMY', 'MEDIUM', 'STANDARD')",
    "check_set_domain": """select p_partkey, p_name from part
        where split_part(p_name, ' ', 1) not in ('red', 'blue', 'small', 'large')
        or split_part(p_name, ' ', 2) not in ('bolt', 'gear', 'ring', 'rod', 'plate')""",
    "check_range": """select c_custkey, c_acctbal from customer where c_acctbal < 0 or c_acctbal > 5000
        or round(cast(c_acctbal as decimal(12,4)), 1) <> cast(c_acctbal as decimal(12,4))""",
    "check_length": "select p_partkey, p_name from part where length(p_name) > 10",
    "check_open_rentals": _with(
        "line",
        """select inventory_id, count(*) as n_open from line where return_date is null
        group by inventory_id having count(*) > 1""",
    ),
    "integrity_report": _report(),
    "fk_restrict": _with(
        "line rental",
        """select c_custkey as customer_id from customer
        where c_acctbal < 0 and exists (select 1 from rental where o_custkey = c_custkey)""",
    ),
    "fk_allowed_deletes": _with(
        "line rental",
        """select c_custkey as customer_id from customer where c_acctbal < 0
        and not exists (select 1 from rental where o_custkey = c_custkey
            and o_orderdate < timestamp '1996-01-01 00:00:00')""",
    ),
    "fk_allowed_staff_deletes": """select s_suppkey as staff_id from supplier
        where s_suppkey not in (select min(s_suppkey) from supplier group by s_nationkey)""",
    "fk_set_null": _with(
        "line rental",
        """select rental_id as payment_id, case when o_orderstatus = 'P' then null else rental_id end as rental_id
        from rental""",
    ),
    "fk_cascade": _with(
        "line rental",
        """select rental_id as payment_id,
            case when c_mktsegment = 'BUILDING' then -o_custkey - 1 else o_custkey end as customer_id
        from rental left join customer on c_custkey = o_custkey""",
    ),
    "pivot_sales": """select o_orderstatus, """
    + ", ".join(
        f"cast(sum(case when o_orderpriority = '{p}' then cast(o_totalprice as decimal(12,2)) end) as decimal(28,2)) as {n}"
        for p, n in [
            ("1-URGENT", "urgent"),
            ("2-HIGH", "high"),
            ("3-MEDIUM", "medium"),
            ("4-NOT SPECIFIED", "other"),
            ("5-LOW", "low"),
        ]
    )
    + " from orders group by o_orderstatus",
}

_FILMS = _film_list(f"concat({_FIRST}, ' ', split_part(s_name, '#', 2))")
_FILMS_CAPITALISED = _film_list(f"concat({_capital(_FIRST)}, ' ', split_part(s_name, '#', 2))")


ORACLES |= {
    "silver_late_staff": ORACLES["silver_stream_enrich"],
    "lakehouse_end_to_end": ORACLES["gold_from_stream"],
    "compact_table": "select * from events",
    "stream_corrupt_records": """select false as broken, count(*) as n_rows from customer
        union all select true, 1""",
    "film_list_parts": _FILMS,
    "view_staff_list": ORACLES["staff_list"],
    "view_film_list": _FILMS,
    "view_film_list_capitalised": _FILMS_CAPITALISED,
    "view_sales_by_store": ORACLES["sales_by_store"],
    "view_sales_by_category": ORACLES["sales_by_category"],
    "view_actor_info": ORACLES["actor_info"],
    "gold_customer_spend_in_order": f"""select customer_name,
        cast(row_number() over (order by total_rental_price desc, customer_name) as bigint) as place
        from ({ORACLES['gold_customer_spend']})""",
    "sales_by_store_in_order": _with(
        "line rental copy place sold",
        """select concat(n_name, ',', r_name) as store,
            cast(row_number() over (order by r_name, n_name, store_id) as bigint) as place
        from (select distinct store_id from sold join copy using (inventory_id)) join place on n_nationkey = store_id""",
    ),
    "sales_by_category_in_order": f"""select category,
        cast(row_number() over (order by total_sales desc, category) as bigint) as place
        from ({ORACLES['sales_by_category']})""",
    "document_find_in_order": f"""select event_id,
        cast(row_number() over (order by value desc, event_id) as bigint) as place from ({ORACLES['document_find']})""",
    "film_list_assembled": _FILMS,
    "actor_info_assembled": ORACLES["actor_info"],
    "film_list_runs": _with(
        "played",
        f"""select film_id, name, row_number() over (partition by film_id order by name, actor_id) as place
        from (select film_id, actor_id, concat({_FIRST}, ' ', split_part(s_name, '#', 2)) as name
            from played join supplier on s_suppkey = actor_id)""",
    ),
    "orders_ranked": """select o_orderkey,
        row_number() over (order by o_orderdate, o_totalprice desc, o_orderkey) as place from orders""",
    "stream_same_content": "select * from customer",
    "stream_salvaged_elements": """select c_custkey, case when c_custkey % 50 not in (7, 11) then c_acctbal end as c_acctbal,
        case c_custkey % 50 when 7 then 'wrong type: c_acctbal' when 11 then 'not valid JSON' end as reason from customer""",
    "silver_selective_replay": ORACLES["silver_stream_enrich"],
    "apply_changes_by_bucket": ORACLES["apply_changes"],
    "check_fk_filtered": ORACLES["check_fk"],
    "fk_set_null_filtered": """select case when o_orderstatus <> 'P' then l_orderkey end as l_orderkey,
        l_linenumber, l_partkey, l_suppkey from lineitem join orders on o_orderkey = l_orderkey""",
    "customer_balance_at_month_ends": _with(
        "film line rental",
        """, ends as (select distinct last_day(o_orderdate) + interval 86399 second as as_of from orders),
        monthly as (select o_custkey, last_day(o_orderdate) as month,
            sum(rental_rate + case when datediff('day', o_orderdate, return_date) > p_size
                then datediff('day', o_orderdate, return_date) - p_size else 0 end
                - cast(l_extendedprice as decimal(12,2))) as owed
            from rental join film on film_id = l_partkey group by all)
        select c_custkey as customer_id, as_of, cast(coalesce(sum(owed), 0) as decimal(28,2)) as balance
        from customer cross join ends left join monthly on o_custkey = c_custkey and month <= cast(as_of as date)
        group by c_custkey, as_of""",
    ),
    "profile_of_stored_months": f"""select *, true as estimate_is_near, true as quantiles_in_order
        from ({ORACLES['table_profile']})""",
    "read_in_even_splits": """select l_orderkey, l_linenumber,
        case when l_orderkey % 3 = 0 then 1 else l_partkey end as l_partkey from lineitem""",
    # Payments moved by whole months, so that those of March 1996 lie in the month before this one.
    "rewards_report_today": f"""select c_custkey as customer_id, c_nationkey as store_id from customer where c_custkey in (
        select o_custkey from (select o_custkey, l_extendedprice, o_orderdate
            + to_months(cast(datediff('month', date '1996-04-01', current_date) as int)) as paid_on
            from lineitem join orders on l_orderkey = o_orderkey)
        where paid_on >= date_trunc('month', current_date) - interval 1 month and paid_on < date_trunc('month', current_date)
        group by o_custkey having sum(cast(l_extendedprice as decimal(12,2))) > 200000 and count(*) > 1)""",
}
