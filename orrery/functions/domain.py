"""Vocabulary of the domain as data. Functions take such tables as parameters; these are the given ones."""

from __future__ import annotations

# Spellings found in titles and what stands for them, applied in this order to folded titles.
REWRITES = (
    (r"\bcolll?ision\b", "collision"),
    (r"\bcollisions\b", "collision"),
    (r"\bavia(?:re|ires?|ere)\b", "aviaire"),
    (r"\boiseau/avion\b|\bavion/oiseau\b|\boiseau avion\b", "aviaire"),
    (r"\brepoussages\b", "repoussage"),
    (r"\bvehicules\b", "vehicule"),
    (r"\baeronefs\b", "aeronef"),
    (r"\bincursions\b", "incursion"),
    (r"\bpassagers?\b", "passager"),
    (r"\bderoutements?\b", "deroutement"),
    (r"\bfuites?\b", "fuite"),
    (r"\bmateriels?\b", "materiel"),
)

# Families of titles in the order in which they are tried, from the most special to the most general.
FAMILIES = (
    ("Collision aviaire", r"aviaire|oiseau|birdstrike|volatile"),
    ("Collision animale", r"collision animale|lievre|renard|\banimal\b|animaux|chevreuil"),
    ("Baisse niveau SSLIA", r"baisse (?:du )?np|baisse.*sslia|np\s?\d\s*iso|niveau.*protection"),
    ("Remise de gaz / approche", r"remise de gaz|remise gaz|go.?around|approche non stabilis|approche interrompue"),
    ("Déroutement", r"deroutement|deroute\b|diversion|retour terrain|demi.?tour"),
    ("Problème technique avion", r"probleme technique|panne avion|retour parking|panne moteur|incident technique"),
    ("État des surfaces", r"etat (?:de la )?surface|revetement|nid de poule|affaissement|degradation.*(?:piste|aire|voie|poste)|trou.*(?:piste|aire|taxiway)|dalle"),
    ("Balisage / éclairage", r"balisage|feux?|eclairage|lumineux|panneau|marquage"),
    ("Incendie / fumée", r"incendie|fumee|explosion|depart de feu"),
    ("Panne système / informatique", r"panne (?:systeme|informatique|reseau|electrique|de courant)|indisponibilite|logiciel|serveur|\bbug\b|dysfonctionnement (?:systeme|informatique|technique)|coupure (?:electrique|de courant)"),
    ("Ligne frontière / sûreté", r"ligne frontiere|\blf\b|surete|intrusion|badge|zone reservee|acces (?:non autorise|ligne)|franchissement.*(?:frontiere|lf)|porte.*ouverte|pietons? (?:en|sur|non)|personne.*(?:piste|aire|zone)"),
    ("Placement / affectation avion", r"placement|affectation|mauvais poste|erreur de poste"),
    ("Incursion / franchissement", r"incursion|franchissement|point d arret|penetration"),
    ("Refus de priorité", r"refus.*priorit|non respect.*priorit"),
    ("Repoussage / tractage", r"repoussage|push ?back|tractage|remorquage"),
    ("Passager indiscipliné", r"paxi|passager indiscipline|passager perturbateur"),
    ("Chargement / bagages", r"bagage|chargement|fret|soute"),
    ("Avitaillement / carburant", r"avitaillement|avitailleur|carburant|kerosene|fuel|jet a-?1|\bplein\b|camion citerne"),
    ("FOD", r"\bfod\b|corps etranger|debris"),
    ("Fuite hydraulique / fluide", r"fuite|epanchement|hydraulique|deversement"),
    ("Quasi-collision", r"quasi.?collision|perte de separation|rapprochement"),
    ("Collision matérielle", r"collision|choc|heurt|accrochage|percut|contact.*(?:avion|aeronef)|touche.*avion|endommag"),
    ("Matériel gênant / encombrement", r"materiel genant|mal stationne|stationnement non|\bgse\b|encombrement"),
    ("Météo / conditions", r"meteo|neige|verglas|orage|\bvent\b|degivrage|brouillard|givre|grele|foudre|visibilite|windshear"),
)

# Themes of recommended actions; a text may have several.
THEMES = (
    ("rappel / sensibilisation", r"rappel|sensibilis|repreciser|recadr"),
    ("formation / recyclage", r"formation|recycl|habilit|e-learning"),
    ("procédure / consigne", r"procedure|consigne|mode operatoire|instruction|protocole"),
    ("débriefing / entretien", r"debrief|entretien|convocation"),
    ("réunion / groupe travail", r"reunion|groupe de travail|comite|commission"),
    ("courrier / diffusion", r"courrier|\bnote\b|diffusion|mail|communication"),
    ("matériel / équipement", r"materiel|equipement|remplacement|reparation|mise hors service"),
    ("balisage / marquage", r"balisage|marquage|signalisation|peinture|panneau|cone"),
    ("contrôle / audit", r"controle|audit|inspection|verification|surveillance"),
    ("sanction / RH", r"sanction|avertissement|mise a pied|retrait de badge"),
    ("étude / analyse", r"etude|analyse|expertise|diagnostic"),
    ("travaux / infrastructure", r"travaux|refection|amenagement|chantier"),
)

# Categories of actions taken; a text may have several.
CATEGORIES = (
    ("collecte / remise en état", r"ramass|collect|retir|deplac|degag|evacu|nettoy"),
    ("rappel / sensibilisation", r"rappel|sensibilis|brief|debrief"),
    ("note / communication", r"note|courrier|mail|diffusion|information"),
    ("procédure / consigne", r"procedure|consigne|mode operatoire"),
    ("travaux / matériel", r"marquage|signalisation|repar|remplac|installation|balise"),
    ("contrôle / inspection", r"inspection|controle|verification|ronde|surveillance"),
    ("formation", r"formation|recyclage|habilitation"),
    ("réunion / coordination", r"reunion|comite|point avec|rencontre"),
)

# Labels of bulletins, as label_key gives them, and the fields that they fill.
LABELS = {
    "operateurs concernes": "operateurs_concernes",
    "sujet": "sujet",
    "objectif": "objectif",
    "contexte": "contexte",
    "contexte aeronautique": "contexte",
    "contexte technique": "contexte",
    "contexte reglementaire": "contexte",
    "exigences reglementaires": "contexte",
    "breve description de l'evenement": "contexte",
    "enseignements de securite": "contexte",
    "actions recommandees": "actions_recommandees",
    "actions recommandee s": "actions_recommandees",
    "actions de reduction de risque": "actions_recommandees",
    "bonnes pratiques identifiees": "actions_recommandees",
    "bonne pratique": "actions_recommandees",
    "suites donnees": "actions_recommandees",
    "prevention des evenements fumees et odeurs": "actions_recommandees",
    "evolution des mesures de reduction des risques": "actions_recommandees",
    "menaces et mesures de reduction des risques": "actions_recommandees",
    "annexe": "annexe",
    "annexes": "annexe",
    "references": "references",
    "reference": "references",
    "autres documents d'information": "references",
}

# Labels, as label_key gives them, that stand as a heading before what they say.
MARKED_LABELS = (
    "contexte aeronautique",
    "contexte technique",
    "contexte reglementaire",
    "exigences reglementaires",
    "breve description de l'evenement",
    "enseignements de securite",
    "suites donnees",
    "prevention des evenements fumees et odeurs",
    "bonnes pratiques identifiees",
    "bonne pratique",
    "actions de reduction de risque",
    "autres documents d'information",
    "evolution des mesures de reduction des risques",
    "menaces et mesures de reduction des risques",
)

# Beginnings of labels that are standard notices, and headings that a page repeats in a short cell.
IGNORED_LABELS = ("une info securite est un document", "info securite dgac", "info securite")
PAGE_HEADINGS = ("info securite dgac", "info sécurité dgac", "n° 20", "no 20")

# Fields that are lists of items.
LIST_FIELDS = ("operateurs_concernes",)

# A router's names of routes and the route of the golden questions that each stands for.
ROUTES = (
    ("analyse", "analyse"), ("agregation", "liste"), ("statistiques", "liste"), ("liste", "liste"), ("requete", "liste"), ("recherche", "recherche"), ("semantique", "recherche"),
    ("recommandation", "recommandation"), ("reco", "recommandation"), ("abstention", "abstention"), ("hors_domaine", "abstention"), ("synthese", "recherche"),
)
