"""Labels, limits and order maps that results must carry unchanged."""

# engagement type
MISSION, TO_CONFIRM, HIRING = "mission_regie", "a_confirmer", "recrutement"
# sector
YES, LIKELY, NO = "OUI", "PROBABLE", "NON"
# freshness window
W_CLOSED, W_UNKNOWN, W_NEW, W_OPEN = "ÉCARTÉE (clôturée)", "INCONNUE", "NOUVEAU", "OUVERTE"
W_REOPENED, W_BACKLOG, W_AGED = "ROUVERTE", "VIVIER", "AGEE"
NEW_DAYS, OPEN_DAYS, BACKLOG_DAYS, SAME_ITEM_DAYS = 7, 21, 90, 15
# posting verdict, best first
V_TOP, V_GOOD, V_CONFIRM, V_BACKLOG, V_OUT = (
    "★★ MATCH CŒUR", "★ À SAISIR", "À CONFIRMER", "VIVIER", "ÉCARTÉE")
V_REFERENCE = "★ RÉFÉRENCE"
VERDICT_ORDER = {V_TOP: 0, V_GOOD: 1, V_CONFIRM: 2, V_BACKLOG: 3, V_OUT: 4}
MERGE_ORDER = {V_TOP: 0, V_GOOD: 1, V_REFERENCE: 2, V_CONFIRM: 3, V_BACKLOG: 4}
# reasons of a rejected posting
R_SCOPE, R_SECTOR, R_HIRING, R_CLOSED = "hors domaine", "hors banque", "CDI / recrutement interne", "clôturée"
R_BACKLOG, R_AGE, R_DATE = "besoin récurrent du cabinet", "âge", "date inconnue"
CONTRACT_LABEL = "contrat"
# notice domain, best first
D_CONFIRMED, D_VERIFY, D_OUT = "IT confirmé", "à vérifier", "hors IT"
DOMAIN_ORDER = {D_CONFIRMED: 0, D_VERIFY: 1, D_OUT: 2}
PROCEDURE_VERIFY, PROCEDURE_UNKNOWN, PROCEDURE_ADAPTED = (
    "procédure à vérifier", "Procédure NC", "PROCEDURE_ADAPTE")
PROCEDURE_ADAPTED_TEXT = "Procédure Adaptée"
OPEN_CALL_PREFIX = "appeloffre"
SERVICES, GOODS, WORKS = "SERVICES", "FOURNITURES", "TRAVAUX"
SERVICE_TYPES = ("services", "service", "prestations intellectuelles", "prestation intellectuelle",
                 "prestations de services")
GOODS_PREFIXES = ("fourniture", "travaux")
OUT_CATEGORIES = ("fournitures", "travaux")
DEADLINE_MIN_DAYS, DATE_MAX_AGE_DAYS = 7, 20
# similarity
JUDGED_OK, JUDGED_LIMIT, JUDGED_OUT = "CONVENABLE", "LIMITE", "HORS_PERIMETRE"
S_PASS, S_VERIFY, S_OUT = "CONVENABLE", "À VÉRIFIER (similarité)", "HORS_PERIMETRE (similarité)"
JUDGE_NAME = "Gemini"   # the name results carry unless a caller gives another
S_ESTIMATED, S_NONE = "À VÉRIFIER (estimé sans Gemini)", "À VÉRIFIER (Gemini indisponible)"
JUDGE_PENDING_PREFIX = "A_VERIFIER"
JUDGE_ERROR, JUDGE_UNAVAILABLE = "A_VERIFIER (erreur Gemini)", "A_VERIFIER (Gemini indisponible)"
SEMANTIC_GATE, SIM_HIGH, SIM_LOW = 35, 75, 55
JUDGE_BATCH, REASON_CHARS = 10, 160
LEXICAL_MAX = 17
MIN_EMBEDDING_DIM = 16
# display defaults
NC, UNSPECIFIED = "NC", "non précisé"
SNIPPET_CHARS, SCAN_CHARS = 160, 50
AUDIT_MAX_AGE = 45
SYNTHESIS_FIELDS = 9
TOPIC_PREFIXES = ("PÔLES", "POLES")
# document names by priority: the first list that has a word of the name
DOCUMENT_PRIORITY = (("ccap",), ("rc", "reglement", "règlement"), ("cctp",))
DOCUMENT_OTHER = 99
# fixed value: the reason of an offer cut before the judge, around its score and the threshold
CUT_REASON = ("Pré-filtre sémantique : hors-sujet (score ", " < ", "), non soumis au juge.")
