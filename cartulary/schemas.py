"""Published schemas and normalisation targets of the three reference tables.

Everything here is a fixed value: field names, order and types are the contract that
consumers of the published tables rely on.
"""

from __future__ import annotations

from pyspark.sql import types as T

COUNTRY_DDL = """
code string, name string, iso3code string,
capital_city struct<name:string,lng:double,lat:double>,
region struct<id:string,value:string>,
adminregion struct<id:string,value:string>,
incomeLevel struct<id:string,value:string>,
lendingType struct<id:string,value:string>,
numeric_code string, wikidata_id string, official_name string,
languages array<struct<code:string,name:string,official:boolean>>,
currencies array<struct<code:string,name:string,symbol:string>>,
un_member boolean, independent boolean, subregion string,
continents array<string>, borders array<string>, landlocked boolean, tld string,
calling_codes array<string>, flag_emoji string, car_side string, start_of_week string,
demonyms struct<female:string,male:string>, m49_code string,
population bigint, area double, gini struct<year:bigint,value:double>,
timezones array<string>,
native_names map<string,struct<official:string,common:string>>,
other_names array<struct<id:string,name:string>>, common_names array<string>
"""

BLOCK_DDL = """
id string, blocktype array<string>, status string, name string,
languages array<string>, links array<struct<url:string,type:string>>,
translations array<struct<lang:string,name:string>>, founded string,
geographic_scope string, regions array<string>,
includes array<struct<id:string,name:string,type:string,status:string,joined:string,role:string,note:string>>,
membership_count bigint, wikidata_id string, legal_status string, description string,
tags array<string>, topics array<struct<key:string,name:string>>,
headquarters struct<city:string,country:string,coordinates:struct<lat:double,lng:double>>,
acronyms array<struct<lang:string,value:string>>, partof array<string>,
dissolved string, predecessor string, successor string,
other_names array<struct<id:string,name:string>>
"""

BLOCK_TYPE_DDL = "id string, name string, other_names array<struct<lang:string,name:string>>"

LEGACY_DDL = """
id string, createdTime string,
fields struct<key:string,nameEN:string,nameRU:string,abbrEN:string,abbrRU:string,
devtype:string,country:array<string>,websiteUrl:string,wikipediaUrl:string,
islocal:string,Languages:array<string>>
"""


def _schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(" ".join(ddl.split()))


def country_schema() -> T.StructType:
    return _schema(COUNTRY_DDL)


def block_schema() -> T.StructType:
    return _schema(BLOCK_DDL)


def block_type_schema() -> T.StructType:
    return _schema(BLOCK_TYPE_DDL)


def legacy_schema() -> T.StructType:
    return _schema(LEGACY_DDL)
