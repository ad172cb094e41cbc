"""Training pages for the block labeller: laid out at random, with each block's label known because the layout made it.

A layout decides what is main text and what is not; how an element is called is decided apart from that: names in
several languages, names without meaning, or none, on elements with or without a meaning of their own. So only what holds across layouts (the place in
the tree, where the page's running text is, links, phrases, names where they are telling) predicts the labels.
"""

from __future__ import annotations

import numpy as np

from .html_blocks import Block, blocks

MARK = "\ue000"  # a private character before the text of main blocks, taken out again by labelled()

# What elements are called, by what they hold.
NAMES = {
    "main": "article content post entry story main body text blog news inhalt artikel beitrag hauptinhalt contenu texte corps contenido articulo cuerpo noticia tekst testo articolo reading prose",
    "nav": "nav navigation navbar menu topmenu hauptmenü navegacion menü navi links toc breadcrumb breadcrumbs pfad ariane migas pagination pager seiten",
    "header": "header masthead topbar banner logo brand branding kopf kopfzeile entete cabecera top",
    "footer": "footer foot bottom fuss fusszeile pied pie copyright colophon impressum legal mentions aviso",
    "side": "sidebar side aside rail widget seitenleiste spalte lateral barra related recommended teaser promo trending verwandt similaires relacionados mehr more",
    "ad": "ad ads advert advertisement sponsor sponsored anzeige werbung publicité pub anuncio publicidad banner promo",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay hinweis datenschutz avis bandeau aviso consentimiento",
    "comments": "comments comment reply replies respond discussion disqus thread kommentare kommentar diskussion commentaires réactions comentarios respuestas opiniones reacties",
    "form": "form search signup login subscribe newsletter anmeldung suche recherche inscription buscar suscripción contact",
    "share": "share sharing social toolbar tools buttons teilen partager compartir tags meta",
}
#: Names that say nothing about what a block of text is, though they hold words that do elsewhere.
ANYWHERE = "legal-analysis form-group with-sidebar comments-open single-post has-ads no-ads header-fixed menu-open social-policy row col container wrapper inner grid section box page site layout theme footer-dark search-results ad-free news-politics logged-in".split()
#: Phrases of side matter.
PHRASES = {
    "nav": "Home|News|Sport|About us|Contact|Startseite|Politik|Kontakt|Über uns|Accueil|Actualités|Inicio|Noticias|Next page|Previous|Weiter|Archive|Blog|Products|Skip to content|Menu",
    "header": "The Daily Page|Site name|Your city online|Log in|Anmelden|Connexion|Suche|Search|Subscribe now",
    "footer": "© {n} {w}. All rights reserved.|© {n} {w}|Copyright {n} {w} GmbH. Alle Rechte vorbehalten.|Tous droits réservés.|Todos los derechos reservados.|Privacy policy|Impressum|Terms of use|Datenschutz|Mentions légales|Aviso legal|Powered by {w}|{w} · {w} {w}",
    "side": "Related stories|Read more|Most read|Das könnte Sie auch interessieren|Mehr zum Thema|À lire aussi|Te puede interesar|Popular posts|Trending now|Archives|Tags: {w}, {w}",
    "ad": "Advertisement|Anzeige|Publicité|Publicidad|Sponsored by {w}|Buy {w} now and save {n}%|{w} {w} from {n} euros|Shop {w} today",
    "notice": "We use cookies to improve your experience.|This site uses cookies. Accept all|Accept|Diese Website verwendet Cookies.|Alle akzeptieren|Nous utilisons des cookies.|Tout accepter|Utilizamos cookies propias y de terceros.|Aceptar|By continuing you agree to our use of cookies.|Please enable JavaScript.|You have {n} free articles left this month. Subscribe|Your browser is out of date.",
    "form": "Email address|E-Mail-Adresse|Adresse e-mail|Correo electrónico|Sign up for our newsletter|Newsletter abonnieren|Submit|Absenden|Envoyer|Enviar|Name|Password|Search|Subscribe|Your message",
    "share": "Share|Tweet|Teilen|Partager|Compartir|Print|Drucken|Like {n}|Follow us|Copy link|{n} shares|Tags: {w} {w}",
    "comments": "Comments|{n} comments|Leave a reply|Kommentare|{n} Kommentare|Commentaires|Comentarios|Leave a comment|Discussion ({n})",
    "reply": "Reply|Antworten|Répondre|Responder|Report|Like",
    "when": "{n} hours ago|vor {n} Stunden|il y a {n} heures|hace {n} horas|{n} May 2021, 10:{n}|2019-03-{n}|{n}.04.2020 um {n} Uhr|Yesterday",
    "byline": "By {w} {w}|Von {w} {w}|Par {w} {w}|Por {w} {w}",
}
NAMES = {k: v.split() for k, v in NAMES.items()}
PHRASES = {k: v.split("|") for k, v in PHRASES.items()}
TAGS = {"nav": ["nav", "ul", "div"], "header": ["header", "div"], "footer": ["footer", "div"], "side": ["aside", "div", "section"], "ad": ["div", "aside", "section"], "notice": ["div", "dialog", "section"], "comments": ["section", "div", "ol", "aside"], "form": ["form", "div", "fieldset"], "share": ["div", "ul", "p"]}
PLAIN = "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one you were her all she there would their we him been has when who will no more if out so said what up its about into than them can only other new some could time these two may then do first any my now such like our over man me even most made after also did many".split()


class Layout:
    """One page. style: 0 telling names, 1 names without meaning, 2 none; semantic: elements that have a meaning of their own."""

    def __init__(self, rng: np.random.Generator, material: list[str]):
        self.rng, self.material = rng, material
        self.style = rng.choice(3, p=[0.6, 0.2, 0.2])
        self.numbers = rng.choice([0.0, 0.02, 0.1])  # of the words are numbers, in main text as elsewhere
        self.semantic = rng.random() < (0.55 if self.style == 0 else 0.7)

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def pick(self, options):
        return options[self.rng.integers(len(options))]

    def words(self, n: int) -> str:
        source = self.pick(self.material).split() if self.material else PLAIN
        at = self.rng.integers(0, max(1, len(source) - n + 1))
        found = (source[at : at + n] + [self.pick(PLAIN) for _ in range(n)])[:n]
        if self.numbers:
            found = [str(self.rng.integers(1, 3000)) if self.chance(self.numbers) else w for w in found]
        return " ".join(found).replace("<", " ").replace("&", "&amp;")

    def sentence(self) -> str:
        text = self.words(int(self.rng.integers(1, 5) if self.chance(0.12) else self.rng.integers(4, 22)))
        return text[:1].upper() + text[1:].rstrip(".,;") + self.pick([".", ".", ".", "?", "!"])

    def sentences(self, low: int, high: int) -> str:
        return " ".join(self.sentence() for _ in range(self.rng.integers(low, high)))

    def phrase(self, role: str) -> str:
        text = self.pick(PHRASES[role])
        while "{w}" in text:
            text = text.replace("{w}", self.words(1), 1)
        return text.replace("{n}", str(self.rng.integers(1, 30)))

    def attributes(self, role: str) -> str:
        """Names that fit what the element holds, or not; extra ones now and then."""
        found = []
        if self.style == 1 and self.chance(0.8):
            found.append("".join(self.pick("abcdefghijklmnopqrstuvwxyz") for _ in range(self.rng.integers(2, 9))))
        elif self.style == 0 and (role != "main" or self.chance(0.85)):  # side matter that looks like main text is named
            name = self.pick(NAMES[role])
            if self.chance(0.35):
                name = self.pick(["site-", "page-", "main-", "c-", "l-", "js-", "article-", "post-", "content-"] if role != "main" else ["c-", "l-", "js-", "main-", "single-", "page-"]) + name
            if self.chance(0.3):
                name += self.pick(["-wrapper", "-inner", "__list", "-box", "-area", "-container", "s", "_block", "-1"])
            found.append(name)
        if role == "main" and self.chance(0.2) or self.chance(0.05):
            found.append(self.pick(ANYWHERE))
        key = "id" if self.chance(0.2) else "class"
        return f' {key}="{" ".join(found)}"' if found else ""

    def box(self, role: str, inner: str, tag: str | None = None) -> str:
        if tag is None:
            tag = TAGS[role][0] if self.semantic and self.chance(0.75) else self.pick(TAGS[role][1:] or TAGS[role])
        if tag == "ul" and "<li" not in inner:
            tag = "div"
        if self.chance(0.2):
            inner = f"<div{' class=inner' if self.chance(0.5) else ''}>{inner}</div>"
        return f"<{tag}{self.attributes(role)}>{inner}</{tag}>"

    def links(self, role: str, low: int = 2, high: int = 9) -> str:
        items = [f'<a href="/{k}">{self.phrase(role) if self.chance(0.5) else self.words(int(self.rng.integers(1, 5)))}</a>' for k in range(self.rng.integers(low, high))]
        kind = self.rng.integers(4)
        return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>" if kind < 2 else " | ".join(items) if kind == 2 else "".join(f"<div>{i}</div>" for i in items)

    def lines(self, role: str, low: int = 1, high: int = 4) -> str:
        tag = self.pick(["p", "div", "span", ""])
        found = [self.phrase(role) if self.style or self.chance(0.7) else self.sentence() for _ in range(self.rng.integers(low, high))]
        return "".join(f"<{tag}>{t}</{tag}>" if tag else t + " " for t in found)

    # Parts of a page that are not main text.

    def nav(self) -> str:
        return self.box("nav", self.links("nav"))

    def header(self) -> str:
        inner = f"<{(t := self.pick(['div', 'h1', 'p', 'a']))}>{self.phrase('header') if self.chance(0.5) else self.words(2)}</{t}>"
        if self.chance(0.5):
            inner += f"<p>{self.words(5)}</p>" if self.chance(0.4) else self.nav()
        return self.box("header", inner)

    def footer(self) -> str:
        copyright = f"{self.pick(['©', '&copy;', 'Copyright'])} {self.words(1)} {self.pick(['·', '&middot;', '-', '|'])} {self.sentence() if self.chance(0.6) else self.words(4)}"
        inner = copyright if self.chance(0.35) else self.lines("footer") + (f"<p>{copyright}</p>" if self.chance(0.4) else "")
        return self.box("footer", inner + (self.links("footer", 1, 5) if self.chance(0.5) else ""))

    def ad(self) -> str:
        return self.box("ad", self.sentence() if self.style == 0 and self.chance(0.6) else self.lines("ad"))

    def notice(self) -> str:
        tag = self.pick(["p", "div", "span"])
        inner = f"<{tag}>{self.phrase('notice')}{' ' + self.sentence() if self.chance(0.3) else ''}</{tag}>" + (f"<button>{self.phrase('notice')}</button>" if self.chance(0.5) else "")
        return self.box("notice", inner)

    def form(self) -> str:
        return self.box("form", "".join(f"<label>{self.phrase('form')}</label><input>" if self.chance(0.6) else f"<p>{self.phrase('form')}</p>" for _ in range(self.rng.integers(1, 4))) + (f"<button>{self.phrase('form')}</button>" if self.chance(0.6) else ""))

    def side(self) -> str:
        inner = f"<h3>{self.phrase('side') if self.style or self.chance(0.7) else self.words(2)}</h3>" if self.style or self.chance(0.7) else ""
        if self.chance(0.6):
            inner += self.links("side")
        for _ in range(self.rng.integers(0, 3) if inner else 1):
            inner += f'<h4><a href="/x">{self.words(5)}</a></h4><p>{self.sentences(1, 3)}</p>' if self.chance(0.6) else f"<p>{self.sentences(1, 3)}</p>"
        return self.box("side", inner)

    def share(self) -> str:
        return self.box("share", self.links("share", 1, 5) if self.chance(0.5) else "".join(f"<span>{self.phrase('share')}</span> " for _ in range(self.rng.integers(1, 4))))

    def comments(self) -> str:
        inner = f"<h3>{self.phrase('comments')}</h3>" if self.chance(0.6) else ""
        tag = self.pick(["li", "div", "article", "p"])
        signed = self.style != 0 or self.chance(0.7)
        for _ in range(self.rng.integers(1, 6)):
            who = f"<{(t := self.pick(['b', 'div', 'span', 'cite']))}>{self.words(1)}</{t}> <time>{self.phrase('when')}</time>" if signed else ""
            answer = f"<a href=#>{self.phrase('reply')}</a>" if signed and self.chance(0.5) else ""
            text = self.sentences(1, 4)
            inner += f"<{tag}>{text}</{tag}>" if tag == "p" else f"<{tag}{self.attributes('comments') if self.chance(0.5) else ''}>{who}<p>{text}</p>{answer}</{tag}>"
        return self.box("comments", inner + (self.form() if self.chance(0.3) else ""))

    # The main text.

    def text(self, tag: str, text: str) -> str:
        if self.chance(0.2):
            at = len(text) // 2
            text = text[:at] + self.pick(["<b>{}</b>", "<em>{}</em>", '<a href="/r">{}</a>', "<i>{}</i>", "<math><mi>{}</mi></math>"]).format(self.words(2)) + text[at:]
        end = "<br>" if tag == "p" and self.chance(0.1) else "" if tag == "p" and self.chance(0.1) else f"</{tag}>"
        return f"<{tag}>{MARK}{text}{end}"

    def body(self) -> str:
        """Paragraphs with headings, lists of all kinds, tables, quotations, pictures and folded parts, and side matter among them; a few bodies are long."""
        size = int(self.rng.integers(30, 160)) if self.chance(0.05) else int(np.clip(self.rng.lognormal(1.6, 0.8), 1, 30))
        short = self.chance(0.15)
        refrain = self.words(int(self.rng.integers(6, 14))) if self.chance(0.12) else ""  # an article may say much the same in every paragraph
        out = []
        for k in range(size):
            kind = self.rng.random()
            if kind < 0.72 and refrain and self.chance(0.9):
                out.append(self.text("p", f"{refrain[:1].upper()}{refrain[1:]}".replace(" ", f" {k if self.chance(0.5) else self.words(1)} ", 1) + "."))
            elif kind < 0.72:
                out.append(self.text("p", self.sentences(1, 2) if short or self.chance(0.25) else self.sentences(2, 8)))
            elif kind < 0.80:
                out.append(self.text(self.pick(["h2", "h3", "h4"]), self.words(int(self.rng.integers(1, 8)))))
            elif kind < 0.85:
                out.append("<ul>" + "".join(self.text("li", self.words(int(self.rng.integers(1, 14)))) for _ in range(self.rng.integers(2, 6))) + "</ul>")
            elif kind < 0.89:
                out.append("<blockquote>" + self.text("p", self.sentences(1, 3)) + "</blockquote>")
            elif kind < 0.92:
                out.append("<figure><img src=a>" + self.text("figcaption", self.sentence()) + "</figure>")
            elif kind < 0.95:
                out.append("<table>" + "".join("<tr>" + "".join(self.text("td", self.words(int(self.rng.integers(1, 4)))) for _ in range(2)) + "</tr>" for _ in range(self.rng.integers(1, 4))) + "</table>")
            elif kind < 0.97:
                out.append(self.text("div", self.sentences(1, 4)))
            elif kind < 0.985:
                out += [f"<details>{self.text('summary', self.words(int(self.rng.integers(2, 9))))}{self.text('p', self.sentences(1, 3))}</details>" for _ in range(self.rng.integers(1, 5))]
            else:
                out.append("<dl>" + "".join(self.text("dt", self.words(int(self.rng.integers(1, 4)))) + self.text("dd", self.sentences(1, 2)) for _ in range(self.rng.integers(1, 5))) + "</dl>")
            if self.chance(0.05) and k < size - 1:
                out.append(self.pick([self.ad, self.side, self.share, self.form])())
        return "".join(out)

    def article(self) -> str:
        head = self.text(self.pick(["h1", "h1", "h1", "h2"]), self.words(int(self.rng.integers(2, 12)))) if self.chance(0.9) else ""
        if head and self.chance(0.25):
            head += self.text("p", self.phrase("byline") if self.chance(0.5) else self.sentence())
        if head and self.chance(0.3):
            head = f"<{(t := self.pick(['header', 'header', 'div', 'hgroup']))}{' class=' + self.pick(['header', 'title', 'kopf', 'entry-header', 'headline']) if self.style == 0 and self.chance(0.6) else ''}>{head}</{t}>"
        inner = self.body()
        if self.chance(0.25):
            inner = f"<{(t := self.pick(['div', 'section']))}{self.attributes('main')}>{inner}</{t}>"
        end = "".join(self.pick([self.share, self.comments, self.side])() for _ in range(self.rng.integers(1, 3))) if self.chance(0.25) else ""
        if self.chance(0.05):
            end += f"<footer>{self.lines('footer')}</footer>"
        outside = head and self.chance(0.1)
        inner = (inner if outside else head + inner) + end
        if self.semantic or self.chance(0.15):
            tag = self.pick(["article", "article", "main", "main"])
            inner = f"<{tag}{self.attributes('main') if self.chance(0.5) else ''}>{inner}</{tag}>"
            if self.chance(0.25) and tag == "article":
                inner = f"<main{self.attributes('main') if self.chance(0.4) else ''}>{inner}</main>"
        elif self.chance(0.9):
            tag = self.pick(["div", "div", "section", "td"])
            inner = f"<{tag}{self.attributes('main')}>{inner}</{tag}>"
            if tag == "td":
                inner = f"<table><tr>{inner}</tr></table>"
        return (head if outside else "") + inner

    def page(self) -> str:
        before = [part() for part, p in ((self.notice, 0.15), (self.header, 0.4), (self.nav, 0.7), (self.ad, 0.3), (self.form, 0.08), (self.side, 0.08), (self.share, 0.05)) if self.chance(p)]
        after = [part() for part, p in ((self.share, 0.12), (self.comments, 0.3), (self.side, 0.35), (self.ad, 0.15), (self.form, 0.15), (self.nav, 0.1), (self.footer, 0.8), (self.notice, 0.15)) if self.chance(p)]
        if self.chance(0.2):
            self.rng.shuffle(before)
        middle = self.article()
        if self.chance(0.05):
            middle += self.article()
        if self.chance(0.25):  # a wrapper around the article and its neighbours
            k = self.rng.integers(0, len(after) + 1)
            middle = f"<div{self.attributes('main')}>{middle}{''.join(after[:k])}</div>"
            after = after[k:]
        page = "".join(before) + middle + "".join(after)
        for _ in range(self.rng.integers(0, 3)):
            page = f'<div class="{self.pick(ANYWHERE)} {self.pick(ANYWHERE)}">{page}</div>' if self.chance(0.6) else f"<div>{page}</div>"
        body = f' class="{" ".join(self.pick(ANYWHERE) for _ in range(self.rng.integers(1, 4)))}"' if self.chance(0.4) else ""
        return f"<html><head><title>{self.words(4)}</title></head><body{body}>{page}{'</body></html>' if self.chance(0.9) else ''}"


def labelled(rng: np.random.Generator, material: list[str]) -> tuple[list[Block], np.ndarray]:
    """The blocks of a page laid out with texts of the material, and 1 for those that are main text."""
    found = blocks(Layout(rng, material).page())
    labels = np.array([MARK in b.text for b in found], np.float32)
    for b in found:
        b.text = b.text.replace(MARK, "").strip()
    keep = [k for k, b in enumerate(found) if b.text]
    return [found[k] for k in keep], labels[keep]
