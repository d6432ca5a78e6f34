"""Declared source schemas as ``{column: type word}`` (see :data:`io.TYPE_WORDS`).

Fixed values: column names, order and types of the source system's tables,
needed to read its CSV exports by position with the right types.
"""

from __future__ import annotations

# Source table schemas (column order matters for CSV reads).
SCHEMAS: dict[str, dict[str, str]] = {
    "contrat": {
        "idctr": "long", "cdetypctr": "string", "numctr": "integer", "indcsbl": "integer",
        "second": "integer", "datdbtctr": "date", "datfinctr": "date", "numinf": "integer",
        "idtercmplx": "integer", "datdbtsys": "date", "datfinsys": "date", "fledit": "integer",
        "biem": "integer", "cdestatutctr": "string", "expireffetimmediat": "integer",
        "idtercess": "integer", "optaffl": "integer", "datfincollect": "date",
    },
    "detcedant": {
        "iddetcedant": "long", "idpcttypdrt": "long", "idctr": "long", "idpcttypdrtcre": "long",
        "numpers": "long",
    },
    "detcedantcatal": {"iddetcedant": "long", "numcatal": "long"},
    "detcess": {
        "iddetcessnr": "long", "cdecategadsacem": "string", "numcatal": "long", "numpers": "long",
        "gestnr": "integer", "datdbtvld": "date", "datfinvld": "date", "idctr": "long",
        "idpcttypdrt": "long",
    },
    "pcttypdrt": {"idpcttypdrt": "long", "idclauspartcl": "string", "cdetypdrtsacem": "string", "pct": "double"},
    "restrctr": {"idrestctr": "long", "idctr": "long", "additif": "integer"},
    "restrgenre": {"idrestctr": "long", "cdegreoeuv": "string"},
    "restroeuv": {"idrestctr": "long", "ide12": "long"},
    "restrpers": {"idrestctr": "long", "numpers": "long", "numcatal": "long", "cdeexignc": "string"},
    "eltter": {
        "ideltter": "long", "idtercmplx": "integer", "cdepaysiso4n": "integer", "incl": "integer",
        "ordaff": "integer", "ord_list": "float",
    },
    "partpt": {
        "idoeuv": "long", "idpartpt": "long", "numnom": "string", "numnomgp": "string",
        "edtrsubst": "string", "partedtr": "float", "let": "string", "cdecategadsacem": "string",
        "numcatal": "long", "numpers": "long", "datdbtvld": "date", "datfinvld": "date",
        "nomdeclt": "string", "prndeclt": "string", "nomfid": "string", "id": "long",
        "dscrmt": "string", "numpartptspeci": "long", "ipnamenrforcage": "long", "idbranche": "long",
    },
    "gpeter": {
        "cdepaysiso4npere": "integer", "cdepaysiso4nfils": "integer", "gpeterfils": "integer",
        "datcre": "date", "usercre": "string", "datmaj": "date", "usermaj": "string",
        "datdbtvld": "date", "datfinvld": "date",
    },
    "oeuv": {
        "idoeuv": "long", "cdestatutoeuv": "integer", "paysori": "integer", "cdegreoeuv": "string",
        "ide12": "long", "datdepot": "date", "datcre": "date", "datdbtsys": "date", "datfinsys": "date",
        "toreindex": "float", "datmaj": "date", "datmajtech": "date", "publierevt": "integer",
    },
    "cess": {
        "idcess": "long", "idtercmplx": "integer", "priort": "long", "idoeuv": "long",
        "datdbtsys": "date", "datfinsys": "date",
    },
    "jeucle": {
        "idjeucle": "long", "datdbtsys": "date", "datfinsys": "date", "datdbtvld": "date",
        "datfinvld": "date", "cdetypdrtsacem": "string", "idcess": "long",
    },
    "ayant_droit": {
        "idayantdrt": "long", "idjeucle": "long", "idpartpt": "long", "cle": "double",
        "numcatalrepst": "long", "cedant": "integer", "gestnr": "integer", "comacc": "integer",
        "cde_motif_mise_en_attente": "integer", "droit_mise_en_attente": "integer",
    },
    "contexts": {
        "num_contexte": "integer", "code_iso4n_pays": "integer", "code_famille_type_utilisation": "string",
        "code_type_utilisation": "string", "code_type_droit": "string", "date_consultation": "date",
        "date_effet": "date",
    },
    "requests": {"ide12": "long", "num_contexte": "integer"},
}

CHAIN_TABLES = ("contrat", "detcedant", "detcedantcatal", "detcess", "pcttypdrt", "restrctr", "restrgenre",
                "restroeuv", "restrpers", "eltter", "partpt", "gpeter")
RESTITUTION_TABLES = ("oeuv", "cess", "jeucle", "ayant_droit", "partpt")
