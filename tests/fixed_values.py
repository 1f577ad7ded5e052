"""Reference identifiers and names."""

# Line identifier, line code and real-time reference.
LINES = [
    ("FR1:Line:C01278:", "C01278", "STIF:Line::C01278:"),
    ("FR1:Line:C01283:", "C01283", "STIF:Line::C01283:"),
    ("FR1:Line:C01377:", "C01377", "STIF:Line::C01377:"),
    ("FR1:Line:C01379:", "C01379", "STIF:Line::C01379:"),
    ("FR1:Line:C01384:", "C01384", "STIF:Line::C01384:"),
    ("FR1:Line:C01729:", "C01729", "STIF:Line::C01729:"),
    ("FR1:Line:C01742:", "C01742", "STIF:Line::C01742:"),
]

# Stop name, normalised name and station.
STOP_NAMES = [
    ("Noisy-le-Grand - Mont d'Est", "noisy le grand mont d est", "NOISY_MONT_EST"),
    ("Noisy - Champs", "noisy champs", "NOISY_CHAMPS"),
    ("La Défense", "la defense", "LA_DEFENSE"),
    ("Havre - Caumartin", "havre caumartin", "HAVRE_CAUMARTIN"),
    ("Val de Fontenay", "val de fontenay", "VAL_DE_FONTENAY"),
    ("Gare de Lyon", "gare de lyon", "GARE_DE_LYON"),
    ("Auber", "auber", "AUBER"),
    ("Rosa Parks", "rosa parks", "ROSA_PARKS"),
    ("Olympiades", "olympiades", "OLYMPIADES"),
    ("Les Olympiades", "les olympiades", "OLYMPIADES"),
    ("Rosa Parks - Curial", "rosa parks curial", "ROSA_PARKS"),
    ("Noisy-Champs RER - Descartes", "noisy champs rer descartes", "NOISY_CHAMPS"),
    ("La Défense (Terminal Jules Verne)", "la defense terminal jules verne", "LA_DEFENSE"),
    ("La Défense (Calder - Miro)", "la defense calder miro", "LA_DEFENSE"),
    ("La Défense (voie Perronet Nord)", "la defense voie perronet nord", "LA_DEFENSE"),
    ("Noisy - Champs RER", "noisy champs rer", "NOISY_CHAMPS"),
    ("Gare de Lyon - Maison de la RATP", "gare de lyon maison de la ratp", "GARE_DE_LYON"),
    ("Gare de Lyon - Diderot", "gare de lyon diderot", "GARE_DE_LYON"),
    ("La Défense (Grande Arche)", "la defense grande arche", "LA_DEFENSE"),
    ("Gare de Lyon - Van Gogh", "gare de lyon van gogh", "GARE_DE_LYON"),
    ("Havre-Caumartin", "havre caumartin", "HAVRE_CAUMARTIN"),
]
