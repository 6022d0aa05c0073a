"""Constants of the domain. They must equal what the data was built with."""

from __future__ import annotations

#: (discipline_id, name, gender)
DISCIPLINES = ((1, "WAG", "F"), (2, "MAG", "M"), (99, "Other", "Unknown"))
#: (gold prefix, apparatus name) in gold column order, by gender.
GOLD_ORDER = {
    "F": (("vt", "Vault"), ("ub", "Uneven Bars"), ("bb", "Beam"), ("fx", "Floor"), ("aa", "All Around")),
    "M": (("fx", "Floor"), ("ph", "Pommel Horse"), ("sr", "Rings"), ("vt", "Vault"), ("pb", "Parallel Bars"), ("hb", "High Bar"), ("aa", "All Around")),
}
ALL_AROUND = "All Around"
APPARATUS_NAMES = {"Balance Beam": "Beam", "AllAround": "All Around", "AA": "All Around", "Horizontal Bar": "High Bar"}
#: Metadata that has a column of its own; the rest goes to details_json.
METADATA_COLUMNS = ("level", "age_group", "session", "division", "group", "prov", "province", "state", "age", "num", "flight", "team", "rotation", "reporting_category")
NAME_GARBAGE = ("#", "name", "athlete", "competitor", "gymnast", "nan", "")
SCRATCH_WORDS = ("S", "DNS", "SCRATCH", "SCR", "WD", "SC")
STATUS_WORDS = {
    "DNS": ("DNS", "DID NOT START", "NO SHOW"),
    "DNF": ("DNF", "DID NOT FINISH", "INCOMPLETE"),
    "SCR": ("SCR", "SCRATCH", "SCRATCHED", "WD", "WITHDREW"),
    "DQ": ("DQ", "DISQUALIFIED"),
    "EXH": ("EXH", "EXHIBITION"),
}
#: Meets with these in their name are of other sports.
OTHER_SPORT = (r"\bt\s*&\s*t\b", r"\bt\s*n\s*t\b", r"\btrampoline\b", r"\btumbling\b", r"\bdouble\s*mini\b", r"\bdmt\b", r"\bpower\s*tumbling\b", r"\bsynchro\s*tramp")
STATES = ("AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY", "DC")
#: Codes and names of provinces as words of a location.
PROVINCES = ("AB", "BC", "MB", "NB", "NL", "NS", "NT", "NU", "ON", "PE", "QC", "SK", "YT", "ALBERTA", "BRITISH COLUMBIA", "MANITOBA", "NEW BRUNSWICK", "NEWFOUNDLAND", "NOVA SCOTIA", "ONTARIO", "PRINCE EDWARD ISLAND", "QUEBEC", "SASKATCHEWAN")
PROVINCES_IN_TEXT = ("ONTARIO", "QUEBEC", "ALBERTA", "BRITISH COLUMBIA", "MANITOBA", "SASKATCHEWAN", "NOVA SCOTIA", "NEW BRUNSWICK")
CLUB_STOP_WORDS = ("gymnastics", "club", "gym", "academy", "centre", "center")
CLUB_BODY_WORDS = ("Gymnastics", "Club", "Association", "Society", "Secondary", "School", "Elem", "High", "District", "Mag", "Wag", "Competitive", "Team", "Secondary School")
DATE_FORMATS = ("MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "d MMMM yyyy", "M/d/yyyy", "d/M/yyyy")
MSO_HEADERS = {"VT": "Vault", "VAULT": "Vault", "UB": "Uneven Bars", "BARS": "Uneven Bars", "BB": "Beam", "BEAM": "Beam", "FX": "Floor", "FLR": "Floor", "FLOOR": "Floor", "AA": "All Around", "PH": "Pommel Horse", "POMML": "Pommel Horse", "SR": "Rings", "PB": "Parallel Bars", "PBARS": "Parallel Bars", "HB": "High Bar", "HIBAR": "High Bar"}
#: Headers that name an apparatus only men or only women have.
MAG_INDICATORS = ("Pommel_Horse", "PommelHorse", "Rings", "Parallel_Bars", "ParallelBars", "High_Bar", "HighBar", "Horizontal_Bar")
WAG_INDICATORS = ("Uneven_Bars", "UnevenBars", "Beam")
MAG_ONLY = ("Pommel Horse", "Rings", "Parallel Bars", "High Bar")
WAG_ONLY = ("Uneven Bars", "Beam")
#: Level codes that only women or only men have.
WAG_LEVEL_CODES = ("XS", "XG", "XP", "XB", "XCEL", "CCP")
MAG_LEVEL_CODE = r"^[PB]\d|^AP|^SR|^SNG|^NG|^J\d"
#: Apparatus headers that come in threes.
RAW_APPARATUS = ("Vault", "Uneven_Bars", "Uneven Bars", "Beam", "Floor", "Pommel_Horse", "Pommel Horse", "PommelHorse", "Rings", "Parallel_Bars", "Parallel Bars", "ParallelBars", "High_Bar", "High Bar", "HighBar", "AllAround", "All_Around", "All Around", "AA")
SESSION_MARKERS = ("day", "session", "flight", "combined", "finals", "apparatus final")
#: Apparatus codes of one site.
KSIS_APPARATUS = {"mfloor": "Floor", "horse": "Pommel Horse", "rings": "Rings", "mvault": "Vault", "pbars": "Parallel Bars", "hbar": "High Bar", "wvault": "Vault", "ubars": "Uneven Bars", "beam": "Beam", "wfloor": "Floor", "vault": "Vault", "bars": "Uneven Bars", "floor": "Floor"}
#: Service headers by their standard names.
COLUMN_ALIASES = {
    "Group": "group",
    "Squad": "group",
    "Session": "session",
    "Sess": "session",
    "Lvl": "level",
    "Level": "level",
    "Div": "age_group",
    "Division": "age_group",
    "Age Group": "age_group",
    "Prov": "province",
    "Province": "province",
    "Execution Bonus": "execution_bonus",
    "Exec Bonus": "execution_bonus",
    "Bonus": "bonus",
}
#: Levels as one site writes them, mapped before LEVELS.
SITE_LEVELS = {
    "Provincial 1": "Provincial 1",
    "Provincial 1A": "P1A",
    "Provincial 1-D": "P1D",
    "Provincial 1 E": "P1E",
    "Provincial 2": "Provincial 2",
    "Provincial 2A": "P2A",
    "Provincial 2B": "P2B",
    "Provincial 2C": "P2C",
    "Provincial 2D": "P2D",
    "Provincial 2E": "P2E",
    "P1": "Provincial 1",
    "P1A": "P1A",
    "P2": "Provincial 2",
    "P3": "Provincial 3",
    "P4": "Provincial 4",
    "P5": "Provincial 5",
    "AP": "Aspire",
    "SR-NG": "Senior Next Gen",
    "SNG": "Senior Next Gen",
    "SrNG": "Senior Next Gen",
    "NGSR": "Senior Next Gen",
    "SRNG": "Senior Next Gen",
    "MNov": "Novice",
    "MNO": "National Open",
    "J16-18": "Junior 16-18",
    "E3": "Elite 3",
    "E4": "Elite 4",
    "B1A": "P1A",
    "B1B": "P1B",
    "B1C": "P1C",
    "B1D": "P1D",
    "B1E": "P1E",
    "B2A": "P2A",
    "B2B": "P2B",
    "B2C": "P2C",
    "B2D": "P2D",
    "B2E": "P2E",
    "B3": "P3",
    "B4": "P4",
    "B5": "P5",
}
#: Levels as written, in order; the first that fits counts.
LEVELS = {
    "Asp MAG (2010-2011)": "Aspire",
    "M1314": "Aspire (13-14)",
    "ASP": "Aspire",
    "AP": "Aspire",
    "AS": "Aspire",
    "NOV": "Novice",
    "NO": "Novice",
    "NO MAG (1991-2009)": "Novice",
    "NO MAG (1991-2008)": "Novice",
    "NO MAG (1990-2007)": "Novice",
    "Provincial 1A": "P1A",
    "Provincial 1-D": "P1D",
    "Provincial 1 E": "P1E",
    "Provincial 2A": "P2A",
    "Provincial 2B": "P2B",
    "Provincial 2C": "P2C",
    "Provincial 2D": "P2D",
    "Provincial 2E": "P2E",
    "SR-NG": "Senior Next Gen",
    "SNG": "Senior Next Gen",
    "SrNG": "Senior Next Gen",
    "NGSR": "Senior Next Gen",
    "SRNG": "Senior Next Gen",
    "MNov": "Novice",
    "MNO": "National Open",
    "Junior 16-18": "Junior (16-18)",
    "J17-18": "Junior (17-18)",
    "M1718": "Junior (17-18)",
    "Junior 17-18": "Junior (17-18)",
    "Junior (17-18)": "Junior (17-18)",
    "M1516": "Junior (15-16)",
    "J14-15": "Junior (15-16)",
    "Junior 14-15": "Junior (14-15)",
    "Junior (14-15)": "Junior (14-15)",
    "J15-16": "Junior (15-16)",
    "Junior 15-16": "Junior (15-16)",
    "Junior (15-16)": "Junior (15-16)",
    "E3": "Elite 3",
    "E4": "Elite 4",
    "P1A": "P1A",
    "B1A": "P1A",
    "B1B": "P1B",
    "B1C": "P1C",
    "B1D": "P1D",
    "B1E": "P1E",
    "B2A": "P2A",
    "B2B": "P2B",
    "B2C": "P2C",
    "B2D": "P2D",
    "B2E": "P2E",
    "B3": "P3",
    "B4": "P4",
    "B5": "P5",
}
#: (country, system, level, maximum, has a D score): the rows a new store starts with.
SCORING_STANDARDS = (
    ("USA", "USAG_DP", "Level 1", 10.0, False),
    ("USA", "USAG_DP", "Level 2", 10.0, False),
    ("USA", "USAG_DP", "Level 3", 10.0, False),
    ("USA", "USAG_DP", "Level 4", 10.0, False),
    ("USA", "USAG_DP", "Level 5", 10.0, False),
    ("USA", "USAG_DP", "Level 6", 10.0, False),
    ("USA", "USAG_DP", "Level 7", 10.0, False),
    ("USA", "USAG_DP", "Level 8", 10.0, False),
    ("USA", "USAG_DP", "Level 9", 10.0, False),
    ("USA", "USAG_DP", "Level 10", 10.0, False),
    ("USA", "USAG_XCEL", "Bronze", 10.0, False),
    ("USA", "USAG_XCEL", "Silver", 10.0, False),
    ("USA", "USAG_XCEL", "Gold", 10.0, False),
    ("USA", "USAG_XCEL", "Platinum", 10.0, False),
    ("USA", "USAG_XCEL", "Diamond", 10.0, False),
    ("USA", "USAG_XCEL", "Sapphire", 10.0, False),
    ("CAN", "CAN_CCP", "Level 1", 10.0, False),
    ("CAN", "CAN_CCP", "Level 2", 10.0, False),
    ("CAN", "CAN_CCP", "Level 3", 10.0, False),
    ("CAN", "CAN_CCP", "Level 4", 10.0, False),
    ("CAN", "CAN_CCP", "Level 5", 10.0, False),
    ("CAN", "CAN_CCP", "Level 6", 10.0, False),
    ("CAN", "CAN_CCP", "Level 7", 10.0, False),
    ("CAN", "CAN_CCP", "Level 8", 10.0, False),
    ("CAN", "CAN_CCP", "Level 9", 10.0, False),
    ("CAN", "CAN_CCP", "Level 10", 10.0, False),
    ("CAN", "CAN_XCEL", "Bronze", 10.0, False),
    ("CAN", "CAN_XCEL", "Silver", 10.0, False),
    ("CAN", "CAN_XCEL", "Gold", 10.0, False),
    ("CAN", "CAN_XCEL", "Platinum", 10.0, False),
    ("CAN", "CAN_XCEL", "Diamond", 10.0, False),
    ("CAN", "CAN_HP", "Novice", None, True),
    ("CAN", "CAN_HP", "Junior", None, True),
    ("CAN", "CAN_HP", "Senior", None, True),
    ("USA", "USAG_ELITE", "Junior", None, True),
    ("USA", "USAG_ELITE", "Senior", None, True),
)
