"""Explicit schemas of the catalogue tables. Password columns are left out on purpose."""

from __future__ import annotations

_INSTANCE_KEY = "DOMAIN_ID int, REPORT_SPECIES_ID int, AS_OF_TIMESTAMP timestamp_ntz, REPROCESS_IN_PROGRESS smallint"

CATALOGUE: dict[str, str] = {
    "FOLDER": "ITEM_ID int, NAME string, PARENT_ID int, PRIVATE_ROOT_ID int, ITEM_TYPE smallint, "
    "CREATED_BY_USER string, CREATION_DATE_TIME timestamp_ntz, LAST_MODIFIED_BY_USER string, "
    "LAST_MODIFIED_DATE_TIME timestamp_ntz, TIME_STAMP timestamp_ntz",
    "FOLDER_SPECIES": "ITEM_ID int, DOMAIN_ID int, REPORT_SPECIES_ID int",
    "REPORT_SPECIES_NAME": "DOMAIN_ID int, REPORT_SPECIES_ID int, ITEM_ID int, NAME string",
    "REPORT_INSTANCE": _INSTANCE_KEY + ", STRUCTURE_DEF_ID int, RPT_FILE_SIZE_KB int, MAP_FILE_SIZE_KB int, "
    "TIME_STAMP timestamp_ntz, FLAGS int",
    "RPTFILE_INSTANCE": _INSTANCE_KEY + ", RPT_FILE_ID int",
    "RPTFILE": "RPT_FILE_ID int, LOCATION_ID int, FILENAME string, STORED_ON_SIDE smallint",
    "SST_STORAGE": "MAP_FILE_ID int, " + _INSTANCE_KEY,
    "MAPFILE": "MAP_FILE_ID int, LOCATION_ID int, FILENAME string, STORED_ON_SIDE smallint",
    "REPORT_INSTANCE_SEGMENT": _INSTANCE_KEY + ", ARRIVAL_TIMESTAMP timestamp_ntz, SEGMENT_NUMBER int, "
    "PAGINATOR_JOB_ID binary, PAGE_STREAM_INSTANCE_NUMBER int, START_PAGE_NUMBER int, NUMBER_OF_PAGES int",
    "SECTION": "DOMAIN_ID int, REPORT_SPECIES_ID int, SECTION_ID int, NAME string, TIME_STAMP timestamp_ntz",
    "FIELD": "STRUCTURE_DEF_ID int, MINOR_VERSION int, LINE_ID int, FIELD_ID int, TAG smallint, OPTIONAL smallint, "
    "START_COLUMN smallint, END_COLUMN smallint, IS_DISTINGUISHER smallint, IS_SIGNIFICANT smallint, "
    "IS_INDEXED smallint, IS_WATERMARKED smallint, IS_INDEX_MERGED_ON_ARCHIVE smallint, OPTIMIZE_FLAGS int, "
    "NAME string, DESCRIPTION string, FIELD_TYPE_LOCALEID int, FIELD_TYPE_NAME string, LINE_SEGMENT_ID int, "
    "STICKY int",
    "LINE": "STRUCTURE_DEF_ID int, MINOR_VERSION int, LINE_ID int, NAME string, DESCRIPTION string, COLOR int, "
    "NOISE smallint, TEMPLATE string, TAG smallint, OPTIMIZE_FLAGS int",
    "SIGNATURE": "SIGN_ID int, MINOR_VERSION int, POSITION int, MATCHING int, REPORT_DATE_TYPE int, DOMAIN_ID int, "
    "REPORT_SPECIES_ID int, DESCRIPTION string, LBD_OFFSETS int, TIME_STAMP timestamp_ntz",
    "SENSITIVE_FIELD": "SIGN_ID int, MINOR_VERSION int, LINE_ID int, LINE_OF_OCCURENCE int, FIELD_ID int, "
    "NAME string, SENSITIVITY int",
    "LINES_IN_SIGN": "SIGN_ID int, MINOR_VERSION int, LINE_ID int, LINE_NUMBER int",
    "SCM_USERS": "SECURITYDOMAIN_ID int, USER_ID int, USERNAME string, FLAGS int, FULLNAME string, DESCRIPTION string",
    "SCM_GROUPS": "SECURITYDOMAIN_ID int, GROUP_ID int, FLAGS int, GROUPNAME string, DESCRIPTION string",
    "SCM_USER_GROUP": "SECURITYDOMAIN_ID int, USER_ID int, GROUP_ID int, FLAGS int",
    "SCM_SECURITYDOMAIN": "SECURITYDOMAIN_ID int, SECURITYDOMAIN_NAME string, FLAGS int, NEXT_USER_ID int, "
    "NEXT_GROUP_ID int, DESCRIPTION string",
    "STYPE_FOLDER": "FOLDER_ID int, VALUE binary",
    "STYPE_REPORT_SPECIES": "REPORT_SPECIES_ID int, VALUE binary",
    "STYPE_SECTION": "REPORT_SPECIES_ID int, SECTION_ID int, VALUE binary",
}

INSTANCE_KEY = ["DOMAIN_ID", "REPORT_SPECIES_ID", "AS_OF_TIMESTAMP", "REPROCESS_IN_PROGRESS"]
