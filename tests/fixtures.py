"""Invented property fixtures (every row exists for a named case)."""

import csv

SF_SMALL = "/root/testdata/sf0.001"

LISTING_COLS = [
    "property_id", "url", "price", "vat", "frontage_width", "leased", "cellar", "attic", "is_furnished", "garage",
    "has_garden", "area", "rooms", "bathrooms", "toilets", "facades_number", "build_year", "state",
    "has_equipped_kitchen", "glazing_type", "heating_type", "certification_electrical_installation",
    "flooding_area_type", "p_score",
]

U = "https://x/en/detail/{sub}/for-sale/{pc}/{loc}/{pid}"

LISTINGS = [
    # P1 villa in 1000: yes/no, vat, frontage, garage 2.0 -> -1, income via French-name fallback
    ["P1", U.format(sub="villa", pc="1000", loc="brussel", pid="p1"), "350000", ": No", "12 m", "Yes", " no ", "yes",
     "1.0", "2.0", "", "150", "4", "2", "2", "4", "1990", "New", "Super equipped", "Double glass", "Gas",
     "yes, certificate in accordance", "Low risk", "x"],
    # exact duplicate of P1 (dedup)
    ["P1", U.format(sub="villa", pc="1000", loc="brussel", pid="p1"), "350000", ": No", "12 m", "Yes", " no ", "yes",
     "1.0", "2.0", "", "150", "4", "2", "2", "4", "1990", "New", "Super equipped", "Double glass", "Gas",
     "yes, certificate in accordance", "Low risk", "x"],
    # P2 ground floor: unmapped state, 'Not specified' heating, NA flooding, no certificate; address fan-out
    ["P2", U.format(sub="ground-floor", pc="1050", loc="ixelles", pid="p2"), "250000", "No", " 7.5m ", "no", "", "",
     "0.0", "1.0", "1.0", "80", "2", "1", "1", "2", "2005", "Ruin", "", "", "Not specified", "",
     "(information not available)", ""],
    # P3 price on request -> dropped
    ["P3", U.format(sub="villa", pc="1000", loc="brussel", pid="p3"), "on request", "", "", "", "", "", "", "", "",
     "100", "", "", "", "", "", "", "", "", "", "", "", ""],
    # P4 url without postal code -> dropped
    ["P4", "https://x/en/detail/villa/for-sale/brussel/p4", "300000", "", "", "", "", "", "", "", "", "100", "", "", "",
     "", "", "", "", "", "", "", "", ""],
    # P5 mixed building (a House subtype) -> dropped by the subtype remap
    ["P5", U.format(sub="mixed-building", pc="1000", loc="brussel", pid="p5"), "400000", "", "", "", "", "", "", "",
     "", "200", "", "", "", "", "", "", "", "", "", "", "", ""],
    # P6 castle -> type Other -> dropped by the type filter
    ["P6", U.format(sub="castle", pc="1000", loc="brussel", pid="p6"), "900000", "", "", "", "", "", "", "", "",
     "500", "", "", "", "", "", "", "", "", "", "", "", ""],
    # P7 area 14 (< 15) -> outlier
    ["P7", U.format(sub="villa", pc="1000", loc="brussel", pid="p7"), "200000", "", "", "", "", "", "", "", "", "14",
     "", "", "", "", "", "", "", "", "", "", "", ""],
    # P8 area 1000 and price 25000 on the bounds -> kept
    ["P8", U.format(sub="bungalow", pc="2000", loc="antwerpen", pid="p8"), "25000", "", "", "", "", "", "", "", "",
     "1000", "3", "", "", "", "", "Normal", "", "", "", "", "", ""],
    # P9 area missing -> -1, exempt from the range -> kept
    ["P9", U.format(sub="studio", pc="2000", loc="antwerpen", pid="p9"), "180000", "", "", "", "", "", "", "", "", "",
     "1", "", "", "", "", "Normal", "", "", "", "", "", ""],
    # P10 price above 5,000,000 -> outlier
    ["P10", U.format(sub="villa", pc="2000", loc="antwerpen", pid="p10"), "6000000", "", "", "", "", "", "", "", "",
     "300", "", "", "", "", "", "", "", "", "", "", "", ""],
    # P11 unknown postal code -> no income -> dropped in stage 2.5
    ["P11", U.format(sub="villa", pc="9999", loc="nowhere", pid="p11"), "300000", "", "", "", "", "", "", "", "",
     "120", "", "", "", "", "", "", "", "", "", "", "", ""],
    # P13 postal code in two municipalities -> two rows
    ["P13", U.format(sub="apartment", pc="1300", loc="wavre", pid="p13"), "310000", "", "", "", "", "", "", "", "",
     "90", "", "", "", "", "", "Normal", "", "", "", "", "", ""],
]

INCOME = [
    ["municipality_upper", "median_income", "", "coord", "municipality"],
    ["BRUXELLES", "30.5", "", "50.8 4.3", "Brussels"],
    ["IXELLES", "28.1", "", "", "Elsene"],
    ["ANVERS", "25.0", "", "", "Antwerp"],
    ["WAVRE", "33.0", "", "", "Waver"],
    ["BRAINE-L'ALLEUD", "35.0", "", "", "Eigenbrakel"],
]

GEO = [
    ["CD_REFNIS", "TX_DESCR_NL", "TX_DESCR_FR", "TX_ADM_DSTR_DESCR_NL", "TX_ADM_DSTR_DESCR_FR", "TX_PROV_DESCR_NL",
     "TX_PROV_DESCR_FR", "POP"],
    ["21004", "Brussel", "Bruxelles", "Arr Brussel", "Arr Bruxelles", "", "Région de Bruxelles-Capitale", "1"],
    ["21004", "Brussel", "Bruxelles", "Arr Brussel", "Arr Bruxelles", "", "Région de Bruxelles-Capitale", "2"],
    ["21009", "Elsene", "Ixelles", "Arr Brussel", "Arr Bruxelles", "", "Région de Bruxelles-Capitale", "1"],
    ["11002", "Antwerpen", "Anvers", "Arr Antwerpen", "Arr Anvers", "Provincie Antwerpen", "Province d'Anvers", "1"],
    ["25112", "Waver", "Wavre", "Arr Nijvel", "Arr Nivelles", "Provincie Waals-Brabant", "Province du Brabant wallon", "1"],
    ["25014", "Eigenbrakel", "Braine-l'Alleud", "Arr Nijvel", "Arr Nivelles", "Provincie Waals-Brabant",
     "Province du Brabant wallon", "1"],
]

POSTAL = [
    ["Postal Code", "Municipality code", "Name"],
    ["1000", "21004", "a"], ["1000", "21004", "a"], ["1050", "21009", "b"], ["2000", "11002", "c"],
    ["1300", "25112", "d"], ["1300", "25014", "e"],
]

ADDRESS = [
    ["property_id", "url", "address"],
    ["P1", "u1", "Rue 1"], ["P2", "u2", "Rue 2"], ["P2", "u2b", "Rue 2 bis"], ["P9", "u9", "Rue 9"],
]


def write_csv(path, rows, sep=",", bom=False, header=None):
    with open(path, "w", newline="", encoding="utf-8-sig" if bom else "utf-8") as fh:
        w = csv.writer(fh, delimiter=sep, quoting=csv.QUOTE_MINIMAL)
        if header:
            w.writerow(header)
        w.writerows(rows)
    return str(path)


def write_all(tmp):
    return {
        "listings": write_csv(tmp / "listings.csv", LISTINGS, header=LISTING_COLS),
        "income": write_csv(tmp / "income.csv", INCOME, bom=True),
        "geo": write_csv(tmp / "geo.csv", GEO),
        "postal": write_csv(tmp / "postal.csv", POSTAL, sep=";", bom=True),
        "address": write_csv(tmp / "address.csv", ADDRESS),
    }
