"""Files of two months as they are landed for the certificate mart."""

from ledgermart.plans.schemas import file_schema

JAN, FEB = "2025-01", "2025-02"


def line(table, **values):
    names = file_schema(table).fieldNames()
    assert set(values) <= set(names)
    return ",".join(str(values.get(n, "")) for n in names)


def land(root, domain, kind, month, lines):
    table = f"raw_{domain}_{kind}"
    folder = root / "raw" / kind / domain
    folder.mkdir(parents=True, exist_ok=True)
    header = ",".join(n.upper() for n in file_schema(table).fieldNames())
    body = "\n".join([header, *[line(table, **x) for x in lines]]) + "\n"
    (folder / f"{domain}_{kind}_{month}.csv").write_text(body)


def dom(key, **more):
    return dict(lmk_key=key, address1="1 High St", postcode="AB1 2CD", current_energy_rating="A",
                potential_energy_rating="A", total_floor_area=10, mains_gas_flag="Y", **more)


def land_month(root, month, domestic, dom_recs=(), display=(), non_domestic=()):
    land(root, "domestic", "certificates", month, domestic)
    land(root, "domestic", "recommendations", month, dom_recs)
    land(root, "display", "certificates", month, display)
    land(root, "display", "recommendations", month,
         [dict(lmk_key=d["lmk_key"], payback_type="short", recommendation_item=1, co2_impact="HIGH") for d in display])
    land(root, "non_domestic", "certificates", month, non_domestic)
    land(root, "non_domestic", "recommendations", month,
         [dict(lmk_key=d["lmk_key"], payback_type=p, recommendation_item=1)
          for d in non_domestic for p in ("short", "long")])


def first_month(root, **more):
    land_month(
        root, JAN,
        [dom("D1", uprn=1, tenure="owned"), dom("D2", uprn=2, tenure="owned", co2_emissions_current=4),
         dom("D3", uprn="", address2="NA")],
        [dict(lmk_key="D1", improvement_item=i, improvement_id=i, indicative_cost=c)
         for i, c in ((1, "Low"), (2, "HIGH cost"), (3, ""))],
        [dict(lmk_key="P1", uprn=9, operational_rating_band="B", current_operational_rating=80,
              electric_co2=1, heating_co2=2, total_floor_area=30)],
        [dict(lmk_key="N1", uprn=8, asset_rating_band="A+", asset_rating=10, floor_area=5, building_emissions=2,
              target_emissions=1, standard_emissions=3, aircon_present="Yes", building_environment="Air")],
    )


def second_month(root):
    land_month(
        root, FEB,
        [dom("D1", uprn=1, tenure="rented", current_energy_efficiency=50), dom("D4", uprn=4)],
        [dict(lmk_key="D4", improvement_item=1, improvement_id=1, indicative_cost="medium")],
        [dict(lmk_key="P2", uprn=9, operational_rating_band="G", current_operational_rating=20)],
        [dict(lmk_key="N2", uprn=8, asset_rating_band="G", asset_rating=20, floor_area=7)],
    )
