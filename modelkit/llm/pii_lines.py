"""A small hand-labelled table for the personal data field: lines with their spans in brackets, as [kind|words]."""

LINES = """
My name is [person|Maria Keller] and I work at the front desk .
Please contact [person|Dr. James O'Neill] about the results .
Signed , [person|Anna Lindqvist]
Name: [person|Peter Baumann] , customer since last spring .
Mr. [person|Robert Hughes] lives at [address|14 Maple Street] near the station .
Mrs [person|Helen Ford] moved to [address|221 Baker Road] last year .
The patient [person|Carlos Mendez] was born on [birth|12 March 1984] in the town .
Date of birth: [birth|03/11/1975]
DOB [birth|1990-07-21] , name [person|Laura Stein]
born [birth|4 July 1969] , address [address|9 Old Mill Lane]
Frau [person|Greta Vogel] , geboren am [birth|02.05.1958] , wohnt hier .
Herr [person|Lukas Brandt] ist unter Telefon [phone|030 555 0199] zu sprechen .
Geburtsdatum: [birth|17.09.2001]
Adresse: [address|Hauptstrasse 12] , zweiter Stock .
Die Straße ist lang und der Platz ist leer .
Madame [person|Claire Moreau] , née le [birth|14 mai 1971] .
Monsieur [person|Jean Petit] habite [address|8 rue des Lilas] .
Téléphone : [phone|01 55 50 12 34]
Señora [person|Lucia Ramos] , nacida el [birth|23 de abril de 1988] .
Su nombre es [person|Diego Torres] y vive en [address|calle Mayor 45] .
Call me at [phone|(555) 010-2234] after six .
Phone: [phone|555-010-7788] or mobile [phone|555 010 9981]
tel. [phone|(020) 7946 0123] ask for the office
His fax is [phone|020-7946-0999] and the cell is [phone|07700 900123] .
The call lasted 45 minutes and cost 12 coins .
Card [card|4111-1111-1111-1111] was refused twice .
Pay with visa [card|5500 0000 0000 0004] today .
account card number: [card|3400 0000 0000 009]
The card game has 52 cards and 4 suits .
Write to [email|jane.doe@example.org] for help .
email [email|support@mail.example.com] or visit us .
Mail me : [email|k_lee at example dot net] please
contact [email|bob (at) example (dot) com]
[email|user42@mail7.example.org] and [email|x9.y10@example.net] wrote back .
phone [phone|(212) 555-0121] and [email|anna88@example.com] or [email|max2000@example.org] later
[email|info3@example.com] , phone [phone|(646) 555 0188] and fax [phone|(646) 555-0189] only
Ask at room 12 , phone [phone|555-013-4410] and then [email|desk5@example.org] or walk in .
They paid with card [card|4000 1234 5678 9017] and phone [phone|(702) 555-0166] was given .
We met at noon and sat at table 9 .
The host is [ip|192.168.10.4] on port 80 .
Server [ip|10.0.0.17] answered in 35 ms .
logged in from [ip|172.16.254.1] at 10:45
Version 3.2.1 was released with 14 fixes .
Chapter 12 of the book has 340 pages .
In 1984 the company had 1200 workers .
The meeting is on 12 March at 10 in room 4 .
It was built in March 1921 by the city .
The street was empty and the lane was dark .
A long road leads to the old mill .
She was born in a small town by the sea .
The name of the game is patience .
Please sign the name on the dotted line .
Der Hund und die Katze schlafen im Garten .
Das Haus an der Ecke ist alt und die Stadt ist groß .
Im Sommer fahren viele Leute an den See .
La maison est grande et le jardin est petit .
Le train arrive à 8 heures et repart à 9 heures .
El perro y el gato duermen en la casa .
La calle es larga y el mercado abre a las 7 .
Mr. Smith's rule is well known in the field .
Licensed under the Public License , Version 2.0 .
Copyright 2019 by the authors , all rights reserved .
The Apache License and the Public License are free .
Order 4471829 shipped in 3 boxes of 20 kg .
The price is 1,299.00 and the tax is 7 percent .
THE SALE ENDS SOON , BUY NOW AND SAVE 50 !
New York and San Francisco are large cities .
Monday and Tuesday are the first days of the week .
Professor [person|Ingrid Hansen] gave the talk on the River Thames .
Dear [person|Thomas Wright] , thank you for your letter .
Kind regards , [person|Sofia Rossi]
Customer: [person|Elena Petrova] , address: [address|77 Lake Avenue]
Send it to [address|1600 Forest Drive] by Friday .
Employee [person|Omar Haddad] ; phone [phone|(312) 555-0143]
Ms. [person|Grace Kim] , born [birth|30/09/1993]
They walked down the avenue to the square .
The number 555 is on the door and 010 is on the gate .
password token and secret are only words here .
It ended. Then they left. Nobody saw it. The door was shut.
Rain fell all day. Und dann kam der Abend. Alle gingen nach Hause.
End of part one.*** Start of part two.*** Final notes.***
First point | Second point | Third point | Summary
This work is licensed under the GNU General Public License, version 3.
Licensed under the Apache License, Version 2.0.
Licensed under CC BY-NC 4.0.
THE END OF THE STORY, AND THE START OF A NEW ONE!
WE CALL IT THE LAW. ALL ROADS ARE CLOSED. ST. PETER WAS A SAINT.
Later. Next. Above. Below. Inside. Outside. Everywhere.
Les enfants jouent dehors. La nuit tombe. Fin du jour.
Los libros son viejos. La puerta es roja. Nada cambia.
from the river to the hill, from the hill to the sea
Erschöpft und müde kamen Wanderer, Hunde und Pferde an.
they sat at the window and looked at the dot on the wall
The token is "9f3a" and the host is away from home.
Then came winter. And so on, and so on, From here to there.
Große Häuser, kleine Gärten, Wälder und Felder liegen dort.
""".strip().splitlines()

# Words that stand beside personal data, by kind, in the languages of the lines.
CUES = {
    "title": "mr mrs ms miss dr prof professor herr frau señor señora monsieur madame dear",
    "name": "name contact signed regards customer patient employee nombre nom",
    "birth": "born birth dob birthday geboren geburtsdatum né née naissance nacido nacida nacimiento",
    "month": "january february march april may june july august september october november december januar februar märz mai juni juli "
    "oktober dezember janvier février mars avril juin juillet août septembre octobre novembre décembre enero febrero marzo abril mayo "
    "junio julio agosto septiembre octubre noviembre diciembre",
    "street": "street st road rd avenue ave lane ln drive boulevard strasse straße platz rue calle avenida plaza",
    "address": "address adresse dirección lives habite vive wohnt",
    "phone": "phone tel telephone mobile cell call fax telefon teléfono téléphone",
    "card": "card visa account karte tarjeta carte",
    "mail": "email mail e-mail correo",
    "spelled": "at dot (at) (dot)",
    "host": "host server ip",
    "works": "license licence public gnu general apache version copyright",
}
