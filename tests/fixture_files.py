"""Writes the FIXTURES.md §3 bulk files (pipe-delimited, header files apart)."""

import os

CAND_HEADER = "CAND_ID,CAND_NAME,CAND_PTY_AFFILIATION,CAND_ELECTION_YR,CAND_OFFICE_ST,CAND_OFFICE,CAND_OFFICE_DISTRICT,CAND_ICI,CAND_STATUS,CAND_PCC"
CMTE_HEADER = "CMTE_ID,CMTE_NM,TRES_NM,CMTE_ST1,CMTE_ST2,CMTE_CITY,CMTE_ST,CMTE_ZIP,CMTE_DSGN,CMTE_TP,CMTE_PTY_AFFILIATION,CMTE_FILING_FREQ,ORG_TP,CONNECTED_ORG_NM,CAND_ID"
LINK_HEADER = "CAND_ID,CAND_ELECTION_YR,FEC_ELECTION_YR,CMTE_ID,CMTE_TP,CMTE_DSGN,LINKAGE_ID"
SA_HEADER = "CMTE_ID,AMNDT_IND,RPT_TP,RPT_YR,IMAGE_NUM,ENTITY_TP,NAME,CITY,STATE,TRANSACTION_DT,TRANSACTION_AMT,CAND_ID,TRAN_ID,SUB_ID"


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def write_receipts_fixture(root, cycles=(2024,)):
    for cycle in cycles:
        _write(f"{root}/candidate_master/candidate_master_{cycle}.txt", [
            "H1|SMITH, JOHN A JR|DEM|2024|OH|H|01|I|C|C1",
            "S1|DOE, DR JANE|REP|2024|PA|S|00|C|C|C2",
            "S1|DOE, DR JANE|REP|2024|PA|S|00|C|C|C2",
        ])
        _write(f"{root}/committee_master/committee_master_{cycle}.txt", [
            "C1|SMITH FOR CONGRESS|T1|||COLUMBUS|OH|43004|P|H|DEM|Q|||H1",
            "C2|JOINT VICTORY|T2|||HARRISBURG|PA|17101|J|N|||||",
        ])
        _write(f"{root}/candidate_committee_linkage/candidate_committee_linkage_{cycle}.txt", [
            f"H1|2024|{cycle}|C1|H|P|1",
            f"H1|2024|{cycle}|C2|N|J|2",
            f"S1|2024|{cycle}|C2|N|J|3",
        ])
    _write(f"{root}/candidate_master/candidate_master_header_file.csv", [CAND_HEADER])
    _write(f"{root}/committee_master/committee_master_header_file.csv", [CMTE_HEADER])
    _write(f"{root}/candidate_committee_linkage/candidate_committee_linkage_header_file.csv", [LINK_HEADER])
    _write(f"{root}/schedule_a/indiv_header.csv", [SA_HEADER])
    _write(f"{root}/schedule_a/2024/itcont_2024_part1.txt", [
        'C1|N|Q1|2024|1|IND|ADAMS, AMY|X|OH|01152024|100||T1|1',
        'C1|N|Q1|2024|2|PTY|STATE PARTY|X|OH|01162024|50||T2|2',
        'C2|N|Q1|2024|3|IND|BAKER, BOB|X|PA|01172024|200||T3|3',
        'C2|N|Q1|2024|4|COM|PAC X|X|PA|01182024|30|H1|T4|4',
        'C1|N|Q1|2024|5|ORG|ACME "INC|X|OH|01192024|x||T5|5',
        'C9|N|Q1|2024|6|IND|CLARK, CY|X|NY|01202024|10||T6|6',
    ])
    # another cycle's file: not requested, must be ignored
    _write(f"{root}/schedule_a/2022/itcont_2022.txt", ['C1|N|Q1|2022|9|IND|OLD, ONE|X|OH|01012022|999||T9|9'])
