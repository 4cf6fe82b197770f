"""Fixed values of the inspection rules. Order matters where a first match decides."""

# Station names, (pattern, station), first hit wins, tested on title-cased text.
# The Keremeos pattern is a regular expression: its brackets group, they match no bracket.
STATIONS = (
    ("Cascade", "Cascade Border"),
    ("Cutts", "Cutts (Hwy 93)"),
    ("Hwy 93 Columbia Lake", "Cutts (Hwy 93)"),
    ("Christina Lake", "Christina Lake"),
    ("Dawson Creek", "Dawson Creek"),
    ("Dry", "Dry Gulch"),
    ("Olsen", "Olsen"),
    ("Pacific", "Pacific"),
    ("Keremeos (Hwy 3)", "Keremeos"),
    ("Paulson", "Paulson Summit"),
    ("Penticton", "Penticton Roving"),
    ("Valemount", "Mt. Robson"),
    ("Salmo", "Salmo"),
    ("Covid", "COVID Border"),
    ("Okanagan", "Okanagan"),
)

# Source codes, exact.
SOURCE_CODES = {
    "unknown": "Unknown",
    "Calgary": "AB",
    "Mexico": "BN",
    "Wi": "WI",
    "Radium": "BC",
    "Sk": "SK",
    "SA": "SK",
    "Ab": "AB",
    "QB": "QC",
    "Yukon Territory": "YT",
    "YK": "YT",
    "Sonora": "SO",
    "Baja California Sur": "BS",
    "Northwest Territories": "NT",
    "NWT": "NT",
    "W": "WA",
    "LI": "LA",
    "KA": "KS",
}

# Region names, (contained text, code), first hit wins.
REGION_NAMES = (
    ("Ontario", "ON"),
    ("British", "BC"),
    ("Alberta", "AB"),
    ("Indiana", "IN"),
    ("Manitoba", "MB"),
    ("Washington", "WA"),
    ("Califor", "CA"),
    ("Sask", "SK"),
    ("Oregon", "OR"),
    ("Nova", "NS"),
    ("Montana", "MT"),
    ("Idaho", "ID"),
    ("Nebraska", "NE"),
    ("Colorado", "CO"),
    ("Minnesota", "MN"),
    ("Texas", "TX"),
    ("Alaska", "AK"),
    ("New York", "NY"),
    ("North Dakota", "ND"),
    ("Tennessee", "TN"),
    ("Michigan", "MI"),
    ("Nevada", "NV"),
    ("Florida", "FL"),
    ("Quebec", "QC"),
    ("South Dakota", "SD"),
    ("West Virginia", "WV"),
    ("Arizona", "AZ"),
    ("Wyoming", "WY"),
)

# Canadian province and territory codes.
CANADIAN_CODES = ("AB", "BC", "MB", "NB", "NL", "NT", "NS", "NU", "PE", "QC", "ON", "SK", "YT")

# Source regions of the preset for infected areas.
INFECTED_SOURCE_REGIONS = (
    "WA", "OR", "CA", "NV", "ID", "MT", "WY", "CO", "UT", "AZ", "NM", "NE", "MI", "OH", "WV", "VA",
    "NC", "PA", "NY", "VT", "NH", "MA", "RI", "CT", "NJ", "DE", "MC", "DC", "AB",
)

# Infected waters within the province; one name needs a nearby city.
INFECTED_WATERS = "(Goat River|Emerald Lake|Elk River|Boulder Creek|Duck Creek)"
AMBIGUOUS_WATER = "Elk River"
AMBIGUOUS_WATER_CITIES = ("Fernie", "Elko")

# Cities that settle the destination province and name.
HOME_PROVINCE = "BC"
HOME_CITIES = ("Chemainus,", "Vernon", "Qualicum Beach", "Langley")
OCEAN_CITIES = ("Chemainus,", "Qualicum Beach", "Langley")
OCEAN = "Pacific Ocean"
OCEAN_PATTERN = "[o,O]cean"
DRY_STORAGE = "Dry Storage"
NO_MATCH = "No Match"
UNKNOWN = "Unknown"

# Craft classes and their counter columns.
CRAFT_COUNTERS = {
    "Non-motorized": "Non_Motorized_Counter",
    "Simple": "Simple_Counter",
    "Complex": "Complex_Counter",
    "Very complex": "Very_Complex_Counter",
}
COUNTERS = ("Simple_Counter", "Complex_Counter", "Very_Complex_Counter", "Non_Motorized_Counter")

# The two made-up boxes (lon, lat corners), watershed 0.
SYNTHETIC_BOXES = {
    "Pacific Ocean": (-130.805, 48.767, -129.090, 49.9512),
    "Dry Storage": (-129.090, 48.767, -127.375, 49.9512),
}

# How many leading rows of the hand-kept lists of 2020, 2021, 2022 are records.
FOULED_LIST_ROWS = {2020: 16, 2021: 17, 2022: 14}

# A station left out of the station summary; a country left out of the label layers.
LEFT_OUT_STATION = "Penticton Roving"
LEFT_OUT_COUNTRY = "Mexico"

# Columns of the trimmed table, in order.
SELECTED_COLUMNS = (
    "Year", "Watercraft_Risk_Assessment_ID", "MusselsFound_Ind", "High_Risk_AIS_Ind", "High_Risk_Area_Ind",
    "Workflow_ID", "Station", "Start_Time", "End_Time", "TimeOfInspection", "Shift_Start_Comment",
    "Shift_End_Comment", "Watercraft_Has_Drainplugs_Ind", "Drainplug_Removed_at_Inspection_Ind",
    "Previous_Waterbody_1_Name", "Previous_Waterbody_1_Closest_City", "Previous_Waterbody_1_Province_Or_State",
    "Previous_Waterbody_1_Other_Details", "Unknown_Previous_Water_Body_Ind", "Previous_Major_City",
    "Destination_Waterbody_1_Name", "Destination_Waterbody_1_Closest_City",
    "Destination_Waterbody_1_Province_Or_State", "Destination_Waterbody_1_Other_Details",
    "Destination_Major_City", "Non_Motorized_Counter", "Simple_Counter", "Complex_Counter",
    "Very_Complex_Counter", "Number_Of_People_In_Party", "Non_Motorized_Blow_Bys_Counter",
    "Motorized_Blow_Bys_Counter", "Total_BlowBys", "Province_Code", "Decontamination_Performed_Ind",
    "Decontamination_order_issued_Ind", "Quarantine_Period_Issued_Ind", "Commercially_Hauled_Ind",
    "New_Passport_Issued_Ind", "Passport_Holder_Ind", "Previous_Inspection_Ind",
    "Previous_Inspection_Source_Name", "Dreissenid_mussels_found_during_previous_inspection",
    "Previous_Inspection_Days_Count", "Previous_AIS_Knowledge_Ind", "Previous_AIS_Knowledge_Source_Code_ID",
    "Clean_Drain_Dry_After_Inspection_Ind", "Seal_Issued_Ind", "General_Comment", "UnknownSourceBoat",
    "DestNotBC", "DryStorage", "Unknown_Destination_Waterbody_Ind", "OceanBoat",
)
