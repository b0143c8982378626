"""The labelled table of the candidate model: forms of personal data and of what only looks like it, in phrases of four languages."""

from __future__ import annotations

import random
import string

#: Forms by kind: ``d`` a digit, ``D`` one of 1 to 9, ``A`` a capital, ``h`` a hex digit, ``x`` a letter or digit, ``w`` a short word; ``|`` splits alternatives.
FORMS = {
    "local_phone": "(Ddd) ddd-dddd|Ddd-ddd-dddd|Ddd.ddd.dddd|0D dd dd dd dd|0Ddd ddddddd|0Ddd/dddddd|Ddd ddd ddd|0Ddd ddd dddd|0Dd-ddddddd|0Dddd dddddd|(0Dd) dddd dddd|Ddd dd dd dd",
    "national_id": "Ddd-dd-dddd|dddddddd-A|ddddddddA|1 dd dd dd ddd ddd dd|2 dd dd dd ddd ddd|dd dddddd A ddd|Ddd dd dddd",
    "iban": "AAdd dddd dddd dddd dddd dd|AAddAAAAdddddddddddddd|AAdddddddddddddddddddddddd|AAdd dddd dddd dddd dddd dddd",
    "spelled_email": "w (at) w (dot) w|w.w[at]w.w|w (at) w.w|w[at]w[dot]w|w.w (at) w.w.w",
    "birth_date": "dd.dd.19dd|dd/dd/19dd|19dd-dd-dd|D.D.19dd|dd-dd-20dd|dd/dd/dd",
    "secret": "hhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhh|hhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhh|xxxxxxxxxxxxxxxxxxxxxxxx|sk-xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx|AAAAddAAddAAddAAddAA|ghp_xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx|xxxxxxddxxxxxx",
}
#: Forms that only ever stand in the phrases against: sums, series, codes.
OTHERS = {
    "local_phone": "D00 D00 D000|Ddd.ddd.ddd|20dd-20dd|Dd ddd ddd|Ddd ddd ddd ddd|dddd dddd dddd|dd.dd dd.dd|D000 D000|978-D-dddd-dddd|20dd/dd/dd",
    "national_id": "D00 D0 D000|Ddd-D0-D000|ddddddddA",
    "iban": "AAddAAAAAAAAAAAAAAAA|AAdd AAAA AAAA AAAA|AA00AAAABBBBCCCC",
    "spelled_email": "w (at) w. W|w (at) w. w",
    "birth_date": "dd.dd.20dd|20dd-dd-dd|dd/dd/20dd|D.D.dd|dd-dd-dd",
    "secret": "w_w_w_ddd|w-w-w-w-dddd|w/w/w/dddd/w|www_w_vd|wwwwddd|20dddddd_dddddd|hhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhhh|AAddd-dddd-ddd|img_dddd_w_w",
}
#: Phrases for a kind, ``{}`` where the candidate stands.
FOR = {
    "local_phone": ["please call {} after noon", "my phone is {}.", "fax {} or mail", "mobile: {}", "Tel. {}", "reach us on {} any day", "rufen Sie {} an", "Telefon: {}", "Handy {}", "appelez le {}", "tél. {}", "téléphone : {}", "llame al {}", "teléfono {}", "móvil: {}", "text me {}", "whatsapp {} works", "her cell {} is off", "anrufen unter {}", "numéro de téléphone {} ou"],
    "national_id": ["ssn {} on file", "social security number {}.", "tax id: {},", "DNI {}", "NIF: {}", "numéro de sécurité sociale {}", "Ausweis {}", "Sozialversicherung {}", "seguridad social {}", "passport {}", "national identity {}"],
    "iban": ["iban {}.", "IBAN: {}", "pay to account {} today", "compte {}", "Konto {}", "cuenta {}", "bank transfer to {}", "bitte auf Konto {} überweisen", "virement au {}"],
    "spelled_email": ["write to {}", "mail {} soon", "contact {}.", "e-mail: {}", "schreiben Sie an {}", "écrivez à {}", "escriba a {}", "courriel {}", "correo: {}", "reach me: {}"],
    "birth_date": ["born {} in", "date of birth: {}", "DOB {}", "geboren am {}", "geb. {}", "Geburtsdatum: {}", "né le {}", "née le {} à", "date de naissance {}", "nacido el {}", "fecha de nacimiento: {}", "born on {}"],
    "secret": ['token = "{}"', "api_key={}", "API key: {}", 'password: "{}"', "secret = {}", "Authorization: Bearer {}", "auth token {}", "access_key = '{}'", "passwd={}", 'les token = "{}" est', "Kennwort: {}", "mot de passe : {}", "contraseña: {}", "login with {}", "my secret is {}"],
}
#: Phrases against any kind.
AGAINST = [
    "order {} was sent", "rows {} and more", "part no. {},", "invoice {}", "sums to {} in all", "{} units", "{} euros", "isbn {}", "version {}", "between {} pieces", "Bestellung {}", "Rechnung {} vom", "facture {}", "commande {}", "pedido {}",
    "factura {}", "Seite {}", "from {} km", "serial {}", "tracking {}", "about {} people", "at {} bytes", "sku {} blue", "model {}", "ref {}", "commit {}", "sha1 {}", "md5: {}", "checksum {}", "http://a.b/{}", "file {}.html", "path {}.png",
    "build {}", "released {}", "since {}", "they met {} and left", "the words {} here", "it was {} then", "page {}", "{} %", "{} times", "the {} of it", "und {} der", "de {} la", "que {} en",
]
WORDS = "ann bob mail example org com net noon home jo lee team info shop north data main test file left image view sub base".split()


def filled(form: str, rng: random.Random) -> str:
    """A form with its placeholders drawn."""
    draw = {
        "d": lambda: rng.choice(string.digits), "D": lambda: rng.choice("123456789"), "A": lambda: rng.choice(string.ascii_uppercase), "h": lambda: rng.choice("0123456789abcdef"),
        "x": lambda: rng.choice(string.ascii_letters + string.digits), "w": lambda: rng.choice(WORDS), "W": lambda: rng.choice(WORDS).title(),
    }
    keep = form[: len(form) - len(form.lstrip("skghp_-"))] if form.startswith(("sk-", "ghp_")) else ""
    marks = (("(at)", "\0"), ("[at]", "\1"), ("(dot)", "\2"), ("[dot]", "\3"))
    rest = form[len(keep) :]
    for mark, code in marks:
        rest = rest.replace(mark, code)
    out = "".join(draw[c]() if c in draw else c for c in rest)
    for mark, code in marks:
        out = out.replace(code, mark)
    return keep + out


def phrase(pattern: str, rng: random.Random) -> tuple[str, str]:
    """The text before and after the candidate, among other words."""
    before, _, after = pattern.partition("{}")
    some = lambda: " ".join(rng.choice(WORDS) for _ in range(rng.randrange(4)))
    return f"{some()} {before}"[-32:], f"{after} {some()}"[:32]


def labelled(each: int = 110, seed: int = 7) -> list[tuple[str, str, str, str, int]]:
    """(kind, candidate, before, after, 1 if personal): ``each`` rows of a kind for and twice as many against.

    A form of the kind is personal in a phrase for it, and not in a phrase against any; a form of the others never is.
    """
    rng, rows = random.Random(seed), []
    for kind, forms in FORMS.items():
        own, other = forms.split("|"), OTHERS[kind].split("|")
        for _ in range(each):
            rows.append((kind, filled(rng.choice(own), rng), *phrase(rng.choice(FOR[kind]), rng), 1))
            rows.append((kind, filled(rng.choice(own), rng), *phrase(rng.choice(AGAINST), rng), 0))
            rows.append((kind, filled(rng.choice(other), rng), *phrase(rng.choice(AGAINST), rng), 0))
    rng.shuffle(rows)
    return rows
